"""Queries over the check tables and the SQL they are compared with."""
