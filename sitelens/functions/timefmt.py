"""Uptime formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import UPTIME_FORMAT


def uptime_hms(seconds) -> Column:
    """Seconds as ``HH:MM:SS``: two digits at least per part, hours unbounded."""
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    s = s.cast("bigint")
    return F.format_string(UPTIME_FORMAT, F.floor(s / 3600).cast("bigint"),
                           F.floor((s % 3600) / 60).cast("bigint"), s % 60)
