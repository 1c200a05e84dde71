"""Validation and state-changing operators, each DataFrame in and DataFrame out."""
