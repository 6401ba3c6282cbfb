"""All registered queries."""

from lodgeframe.queries import (  # noqa: F401
    daily,
    distributions,
    gold,
    groups,
    histories,
    quality,
    texts,
    values,
)
from lodgeframe.queries.registry import QUERIES, Tables

__all__ = ["QUERIES", "Tables"]
