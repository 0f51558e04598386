"""Column expressions: text, time, measures. All run inside generated JVM code."""
