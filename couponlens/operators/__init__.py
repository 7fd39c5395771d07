"""Filters, lookups, period comparison, KPIs, behaviour and mix analysis."""
