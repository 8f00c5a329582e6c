"""Anomalies against a climatology (C7), as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def anomaly(value, norm) -> Column:
    """Value minus normal; missing if either is."""
    return _c(value) - _c(norm)


def normalised_anomaly(value, norm, sd) -> Column:
    """Anomaly in standard deviations; missing without a positive one."""
    sd = _c(sd)
    return F.when(sd > 0, anomaly(value, norm) / sd)
