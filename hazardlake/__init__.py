"""hazardlake: wildfire-hazard analytics on Spark DataFrames and Structured Streaming."""
