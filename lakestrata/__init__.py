"""Layered (bronze -> silver -> gold) customer analytics as plain PySpark functions."""
