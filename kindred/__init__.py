"""Customer-data operators on Spark DataFrames: ingest, union, stage, prepare, unify, report."""
