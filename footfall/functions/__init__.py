"""Column builders: built-in expressions only, no Python UDF."""
