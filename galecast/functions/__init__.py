"""Column expressions: plain Spark SQL functions, no Python workers."""
