"""ratinglens: customer-review analytics as PySpark DataFrame functions."""
