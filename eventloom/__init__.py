"""Spark-native analytics over repository-activity event feeds.

The package turns hourly JSON event files (or a live stream of the same
messages) into a deduplicated raw table, typed staging models, per-entity
rollups, a star schema with type-2 history, ranked marts, anomaly reports,
data-quality results and run metrics.  Every step is a plain function from
DataFrames to a DataFrame; only the sinks and ``plans.pipeline`` run jobs.
"""
