"""Queries of the library on the driver's tables, each with its SQL twin."""
