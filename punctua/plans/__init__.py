"""Whole jobs: raw files to cleaned tables, cleaned tables to KPI tables."""
