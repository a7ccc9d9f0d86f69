"""Spark-first medallion analytics for multi-source match and player data."""
