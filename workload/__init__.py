"""Queries over the driver's tables: adapters, registered queries and their SQL counterparts."""
