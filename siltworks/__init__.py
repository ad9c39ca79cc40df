"""A Spark-native refinery for conversational training data."""
