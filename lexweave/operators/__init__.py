"""Relational operators: latest state, numbering, phases, snapshots, checks."""
