"""Whole plans built from the operators: gold tables, KPIs, views, loads."""
