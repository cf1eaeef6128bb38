"""Column expressions; all of them are built-in JVM functions."""
