"""Analytics over captured DNS traffic, written as plain Spark DataFrame jobs."""
