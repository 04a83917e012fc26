"""Operators bound to the tables of a folder, each with its SQL twin where SQL can say it."""

from millrace.plans import (  # noqa: F401
    features,
    formats,
    insights,
    lake,
    markets,
    monitoring,
    orders,
    sales,
    warehouse,
    weather,
)
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
