"""Text helpers. All of them return NULL when any input is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_newlines(text: Column) -> Column:
    """Each run of line feeds and carriage returns becomes one space."""
    return F.regexp_replace(text, r"[\n\r]+", " ")


def clock(ts: Column) -> Column:
    """``HH:MM`` of a timestamp."""
    two_digits = [F.lpad(part.cast("string"), 2, "0") for part in (F.hour(ts), F.minute(ts))]
    return F.concat(two_digits[0], F.lit(":"), two_digits[1])


def label(*parts: Column | str) -> Column:
    """Concatenate columns and plain strings (``format_string`` would print ``null``)."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
