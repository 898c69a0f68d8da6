"""Column expressions: goals and signed numbers, half-aware match clock,
pixel hex / colour naming, calendar fields. All are built-in Spark SQL
expressions (no Python UDF)."""
