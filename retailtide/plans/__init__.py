"""Queries: the given tables as shop entities, and each operator run over them."""
