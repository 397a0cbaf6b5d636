"""Environmental sensor analytics as plain Spark DataFrame and Structured Streaming code."""
