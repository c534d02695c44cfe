"""Column-level helpers, all built from JVM-side expressions."""
