"""Registered queries and the SQL that checks them."""

from ratingloom.catalog import collaborative, content, storage, tables, text  # noqa: F401
from ratingloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
