"""Registered queries over the shared test tables, each with its SQL counterpart."""

from .oracle import ORACLE
from .queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
