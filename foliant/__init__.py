"""foliant: a Spark-native engine for textbook corpora."""
