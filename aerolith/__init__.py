"""Sensor time-series features and forecasting as Spark DataFrame operators."""
