"""Column expressions. All are built-in JVM expressions; none is a Python UDF."""
