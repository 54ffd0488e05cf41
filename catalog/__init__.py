"""Every operator as a query over the given tables, beside the SQL that must give the same rows."""

from catalog import (  # noqa: F401
    cleaning,
    evaluation,
    features,
    forests,
    modelling,
    penalties,
    scans,
    search,
    splits,
    statistics,
)
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
