"""Word-timing jobs on Spark."""
