"""Charging-network analytics as Spark DataFrame transformations."""
