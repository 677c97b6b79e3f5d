"""Column functions. All are built from native expressions, none is a UDF."""
