"""Warehouse jobs as Spark DataFrame plans."""
