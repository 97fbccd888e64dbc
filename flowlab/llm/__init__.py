"""Operators of a training-data pipeline: deduplication, filtering, scoring, tokenising and
packing of document tables. Every operator takes DataFrames and returns DataFrames; nothing
outside this subpackage imports it."""
