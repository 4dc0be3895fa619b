"""kbweave: incremental knowledge-base building and hybrid retrieval on PySpark."""
