"""Structured Streaming jobs (St1-St7) around the batch operators."""
