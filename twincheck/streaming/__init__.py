"""Continuous intake of dropped files."""
