"""Event-time column expressions. The session time zone is pinned to UTC."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_UNIT = {"second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def width_ms(width: str) -> int:
    """Milliseconds in a width such as ``"5 minutes"``."""
    match = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", width)
    if not match:
        raise ValueError(f"unsupported width: {width!r}")
    return int(match[1]) * MS_PER_UNIT[match[2]]


def to_ms(time: Column) -> Column:
    return F.unix_millis(time)


def floor_ms(ms: Column, step: int) -> Column:
    """Largest multiple of ``step`` not above ``ms``, also before the epoch."""
    return ms - F.pmod(ms, F.lit(step))
