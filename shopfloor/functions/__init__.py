"""Column expressions. All run inside Spark SQL; none is a Python UDF."""
