"""Number expressions for metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_change(current: Column, previous: Column, digits: int = 2) -> Column:
    """100 * (current - previous) / previous; null when previous is null or 0."""
    change = (current - previous).cast("double") * 100 / F.nullif(previous.cast("double"), F.lit(0.0))
    return F.round(change, digits)
