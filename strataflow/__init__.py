"""Layered analytics (landing, raw, curated, consumption) as PySpark DataFrame operators."""
