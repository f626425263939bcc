"""Registered queries and, next to them, the SQL they are checked against."""
