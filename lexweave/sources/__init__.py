"""Readers for landed records: files, page envelopes, events."""
