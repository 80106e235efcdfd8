"""Retail sales analytics on PySpark: raw, refined and curated layers, insights, forecasts."""

__version__ = "0.1.0"
