"""Spark-native analytics for regular time series such as utility-meter readings."""
