"""Column expressions: `Column -> Column`, all evaluated inside the JVM."""
