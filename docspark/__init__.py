"""docspark: load, transform, analyse, copy and export document collections on Spark."""
