"""Analyses and the two end-to-end jobs."""
