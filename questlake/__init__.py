"""Catalog analytics as Spark DataFrames: variant loads, latest-version staging,
ranked and aggregated marts, quality gates, keyed merges and vector search."""
