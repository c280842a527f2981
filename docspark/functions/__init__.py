"""Column functions: everything here returns a Column and runs inside the JVM unless stated."""
