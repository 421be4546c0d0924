"""Retail KPI and retention analytics expressed as Spark DataFrame jobs."""
