"""The registered queries and the SQL that states their results."""

from barograph.catalog import models, rows, tables, windows  # noqa: F401
from barograph.catalog.models import flagged_readings
from barograph.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagged_readings"]
