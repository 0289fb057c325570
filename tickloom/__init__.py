"""Layered market-ticker analytics as PySpark DataFrame functions."""
