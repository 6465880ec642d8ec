"""Column expressions: every function takes and returns Spark columns, none is a UDF."""
