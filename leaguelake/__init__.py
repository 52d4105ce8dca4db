"""League analytics on Spark: landing, staging, standings, marts, checks and serving."""
