"""Structured Streaming versions of the cleaning steps and the task ledger."""
