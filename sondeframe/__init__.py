"""Spark-native analytics for gridded climate and satellite data."""
