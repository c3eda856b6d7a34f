"""Layered batch tables on Spark: raw JSON batches, typed keyed rows, reporting tables, gated publication."""
