"""Training-data operators: filters, dedup, packing, extraction and scans.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only when it can be imported.
"""
