"""Operators over DataFrames: curate, views, enrichment, quality checks."""
