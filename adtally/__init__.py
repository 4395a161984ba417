"""Ad-event analytics as Spark DataFrames and Structured Streaming."""
