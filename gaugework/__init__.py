"""Predictive-maintenance analytics as Spark DataFrame operators."""
