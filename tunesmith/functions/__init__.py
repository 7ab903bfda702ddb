"""Column-level building blocks (JVM expressions only)."""
