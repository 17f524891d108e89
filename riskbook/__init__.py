"""Property-risk and loan-book analytics as plain Spark DataFrame functions."""
