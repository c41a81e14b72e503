"""Registered queries over the synthetic tables, each with the SQL it must agree with."""
