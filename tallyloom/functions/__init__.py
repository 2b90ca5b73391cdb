"""Column functions. All are built from Spark's own functions, so they stay in generated code."""

from tallyloom.functions.numeric import next_pow2, strict_greatest, strict_least
from tallyloom.functions.text import clean_newlines, clock, label
from tallyloom.functions.time import (
    PERIOD_UNITS,
    iso_dow,
    last_midnight_before,
    midnight,
    period_day,
    period_start,
    whole_days,
    whole_seconds,
)

__all__ = [
    "PERIOD_UNITS",
    "clean_newlines",
    "clock",
    "iso_dow",
    "label",
    "last_midnight_before",
    "midnight",
    "next_pow2",
    "period_day",
    "period_start",
    "strict_greatest",
    "strict_least",
    "whole_days",
    "whole_seconds",
]
