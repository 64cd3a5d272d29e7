"""The queries the repository registers, over the given tables, with their SQL counterparts."""
