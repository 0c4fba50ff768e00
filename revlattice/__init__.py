"""Recurring-revenue analytics as Spark DataFrame plans."""
