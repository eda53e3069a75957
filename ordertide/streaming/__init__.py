"""Continuous change capture."""
