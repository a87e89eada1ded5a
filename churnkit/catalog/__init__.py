"""Queries over the given tables, each with SQL for the same rows wherever there is any."""
