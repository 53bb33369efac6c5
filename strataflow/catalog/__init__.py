"""Registered queries: each is a DataFrame builder over the given tables plus its SQL twin."""

from .registry import QUERIES, SQL, load_all

__all__ = ["QUERIES", "SQL", "load_all"]
