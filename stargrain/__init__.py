"""stargrain: governed analytics tables on Spark, from raw files to metrics."""
