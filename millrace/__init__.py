"""millrace: lakehouse analytics and ML data operators as plain Spark DataFrame code."""
