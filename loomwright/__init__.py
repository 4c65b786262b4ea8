"""A Spark-first analytics engine for news, event and label data."""
