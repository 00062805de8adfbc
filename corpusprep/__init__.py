"""Text-corpus preparation, data-quality and metric queries on Spark DataFrames."""
