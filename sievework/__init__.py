"""A Spark-native engine for curating training data."""
