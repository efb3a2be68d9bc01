"""Column functions; all are JVM-side expressions."""
