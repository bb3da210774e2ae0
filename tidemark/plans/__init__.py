"""Queries by operator, each with the SQL it must agree with."""
