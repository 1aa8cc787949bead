"""Streaming versions of features that make sense on an open log."""
