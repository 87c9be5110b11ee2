"""Trip-record analytics written as plain Spark DataFrame jobs."""
