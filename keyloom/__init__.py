"""keyloom: keep two keyed datasets in step with plain Spark DataFrames and streams."""
