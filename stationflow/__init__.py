"""Station time-series analytics on PySpark."""
