"""Column expressions. All run inside the JVM except the list-literal fallback."""
