"""Queries on the driver tables and their SQL counterparts."""
