"""Registered queries, their oracle SQL and the views over the given tables they read."""
