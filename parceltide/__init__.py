"""Control-tower analytics for parcel logistics on Spark DataFrames and Structured Streaming."""
