"""Spark-native warehouse for market ticks: every operator is a DataFrame -> DataFrame function."""
