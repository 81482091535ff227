"""Hourly and daily jobs, and the catalogue of checked queries."""
