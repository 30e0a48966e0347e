"""Column expressions: everything here stays inside Spark SQL code generation."""
