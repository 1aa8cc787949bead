"""Operators on event logs and customer panels; each takes and returns DataFrames."""
