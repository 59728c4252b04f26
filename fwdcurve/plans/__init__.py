"""Queries of the library over the star-schema tables, each with a SQL twin where SQL can express it."""
