"""Registered queries: the library's operators over the given tables, and their SQL twins."""
