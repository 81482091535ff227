"""Hourly micro-batches: late data and replay by recompute, landed files by a file stream."""
