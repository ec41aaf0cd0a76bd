"""Column expressions (JVM-side, no Python UDFs) shared by the operators."""
