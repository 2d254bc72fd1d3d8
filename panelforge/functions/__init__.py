"""Column builders (JVM-side expressions only)."""
