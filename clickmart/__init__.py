"""Clickstream to product and visitor tables, as PySpark DataFrame operators."""
