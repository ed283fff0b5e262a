"""All named queries over the given tables."""

from . import customers, features, lifetime, relational, statistics, tables  # noqa: F401
from .registry import QUERIES, Query  # noqa: F401
