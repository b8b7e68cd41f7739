"""Staging, warehouse, profile, scoring, products and quality plans."""
