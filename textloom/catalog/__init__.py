"""Registered queries with the SQL each must agree with."""

from textloom.catalog import explore, ingest, texts, vectors  # noqa: F401
from textloom.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
