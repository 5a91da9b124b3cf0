"""Training-data operators: text, token and embedding work on Spark tables."""
