"""Operators of the panel engine: DataFrame in, DataFrame out, keyed by design_id."""
