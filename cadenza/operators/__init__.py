"""Relational operators of the catalogue workloads, as DataFrame compositions."""
