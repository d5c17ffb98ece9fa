"""Predictive-maintenance analytics as Spark DataFrame and Spark ML plans."""
