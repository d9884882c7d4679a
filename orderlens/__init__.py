"""Order-profitability analytics as plain Spark DataFrame jobs."""
