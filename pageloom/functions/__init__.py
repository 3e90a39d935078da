"""Column expressions: all built-in functions, so that they stay inside the JVM."""
