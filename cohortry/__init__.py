"""Consumer-transaction and audience analytics as Spark DataFrame functions."""
