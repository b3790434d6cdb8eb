"""Spark-first analytics over regulatory and legislative monitoring data."""
