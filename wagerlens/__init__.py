"""Wagering analytics as Spark DataFrame operators."""
