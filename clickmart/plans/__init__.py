"""Batch jobs composed from the operators: each reads, writes and returns a run summary."""
