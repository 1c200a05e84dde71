"""Staging jobs, mart queries and the source tables they run on."""
