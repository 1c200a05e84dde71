"""Incremental intake, in batches and as a stream."""
