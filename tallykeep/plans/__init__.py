"""Compositions of operators: KPI pipeline, dataset overview, insights."""
