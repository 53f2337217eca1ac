"""Column functions: every one is a Catalyst expression, none is a Python UDF."""
