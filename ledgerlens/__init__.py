"""Fraud analytics on Spark: raw transactions to quality-scored, silver and gold tables."""
