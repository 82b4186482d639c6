"""Whitelists, source-to-target mappings and the declared warehouse."""
