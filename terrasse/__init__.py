"""Terrasse: layered (bronze, silver, gold) data work as plain Spark DataFrame operators."""

__version__ = "0.1.0"
