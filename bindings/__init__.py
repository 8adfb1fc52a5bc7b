"""The operators bound to the given tables, and the same queries as SQL."""
