"""Column expressions: each takes and returns ``Column`` objects, all JVM-side."""
