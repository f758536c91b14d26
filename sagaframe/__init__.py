"""sagaframe: an analytics engine for long-form text built on Spark DataFrames."""
