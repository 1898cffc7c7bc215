"""Road corridor congestion analytics on Spark, in batch and streaming."""
