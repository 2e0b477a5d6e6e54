"""Column expressions: text, scoring and array/matrix functions (JVM-side)."""
