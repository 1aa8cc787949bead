"""Registered queries with their SQL, and the staged pipeline."""
