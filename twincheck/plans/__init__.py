"""Whole validations put together from operators."""
