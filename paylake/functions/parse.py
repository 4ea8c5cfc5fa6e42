"""Lenient parsers: bad input becomes null, never an exception (ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylake.functions.text import strip
from paylake.schemas import TIMESTAMP_FORMAT


# ``yyyy-MM-dd HH:mm:ss`` with an optional fraction of 1 to 6 digits; ISO has a T between.
_DEFAULT_TS = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?\z"
_ISO_TS = _DEFAULT_TS.replace(" ", "T")


def parse_timestamp(c: Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text -> ``timestamp_ntz`` with one declared format; anything else -> null.

    A bare ``cast`` would accept ``'12:30'`` (today at 12:30) or ``'2024'``, so the
    text has to match the declared format first. No time zone is involved in a
    cast to ``timestamp_ntz``: a wall-clock time inside a DST gap of the session
    zone is kept as written, and impossible dates give null. Other formats go
    through ``try_to_timestamp`` (interpreted in the session time zone).
    """
    if fmt != TIMESTAMP_FORMAT:
        return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
    return F.when(c.rlike(_DEFAULT_TS), c.try_cast("timestamp_ntz"))


def parse_iso_timestamp(c: Column) -> Column:
    """ISO text (``yyyy-MM-ddTHH:mm:ss`` with an optional fraction) -> ``timestamp_ntz``;
    anything else -> null. No time zone is involved."""
    return F.when(c.rlike(_ISO_TS), c.try_cast("timestamp_ntz"))


def parse_decimal(c: Column, precision: int = 12, scale: int = 2) -> Column:
    """Text -> decimal; ``N/A``, ``NaN``, ``inf``, ``1.5d`` and overflow -> null.

    A decimal target (not double) keeps money exact and rejects NaN, which a
    double cast would accept (and ``NaN > 0`` is true in Spark).
    """
    return strip(c).try_cast(f"decimal({precision},{scale})")
