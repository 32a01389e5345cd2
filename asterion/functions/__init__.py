"""Column builders. Everything here returns native Spark expressions."""
