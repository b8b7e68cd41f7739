"""Customer analytics and credit-risk scoring as plain Spark DataFrame functions."""
