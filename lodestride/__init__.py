"""Spark-native decision analytics: features, policies, off-policy evaluation."""
