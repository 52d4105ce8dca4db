"""Operators for preparing training text: dedup, identification, filtering, tokens, packing.

Every operator takes DataFrames and returns DataFrames. `queries` holds the thin registered queries.
"""
