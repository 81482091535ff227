"""Readers and the frames derived from what has landed."""
