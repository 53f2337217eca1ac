"""Operators over DataFrames: filters, dedup, linking, link graph, search, quality and size."""
