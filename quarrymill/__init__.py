"""quarrymill: corpus analytics written for Spark's DataFrame and SQL engine."""
