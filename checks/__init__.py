"""Inputs, queries and SQL for checking the operators on the driver's tables."""
