"""Column expressions: everything here runs inside Spark's generated code."""
