"""Urban sensor analytics on Spark: change feeds and streams in, silver and gold tables and reports out."""
