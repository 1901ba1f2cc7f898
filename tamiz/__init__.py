"""Tamiz: data-quality, incremental-load and analytics operators for PySpark."""
