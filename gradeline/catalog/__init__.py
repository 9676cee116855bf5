"""The registered queries: each operator bound to the given tables, with its SQL twin."""

from gradeline.catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]
