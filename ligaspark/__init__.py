"""Contact-data analytics on Spark: sources, operators, plans and streaming helpers."""
