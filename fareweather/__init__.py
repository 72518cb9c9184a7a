"""Trip and weather analytics built on Spark DataFrames and Structured Streaming."""
