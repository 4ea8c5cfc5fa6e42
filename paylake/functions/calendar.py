"""Calendar fields derived from a timestamp or a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_name(ts: Column) -> Column:
    """English full day name (``Monday``)."""
    return F.date_format(ts, "EEEE")


def is_weekend(ts: Column) -> Column:
    """Saturday or Sunday (``weekday`` counts Monday = 0)."""
    return F.weekday(ts) >= 5


def padded_month_name(d: Column) -> Column:
    """Month name blank-padded to 9 characters, as ``to_char(d, 'Month')``."""
    return F.rpad(F.date_format(d, "MMMM"), 9, " ")


def padded_day_name(d: Column) -> Column:
    """Day name blank-padded to 9 characters, as ``to_char(d, 'Day')``."""
    return F.rpad(F.date_format(d, "EEEE"), 9, " ")


def epoch_micros(ts: Column) -> Column:
    """Wall-clock microseconds since 1970-01-01 00:00 of a timestamp, read as
    ``timestamp_ntz``: built from its calendar fields, so it does not depend
    on the session time zone and is monotonic (no DST folds or gaps)."""
    t = ts.cast("timestamp_ntz")
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    secs = F.date_part(F.lit("SECOND"), t)  # seconds with the fraction, decimal(8,6)
    return (days * 86_400_000_000 + F.hour(t).cast("long") * 3_600_000_000
            + F.minute(t).cast("long") * 60_000_000 + (secs * 1_000_000).cast("long"))


def gap_seconds(prev: Column, ts: Column) -> Column:
    """Fractional wall-clock seconds from ``prev`` to ``ts`` (microsecond
    exact; ``timestampdiff(SECOND, ...)`` would truncate 119.9 s to 119)."""
    return (epoch_micros(ts) - epoch_micros(prev)) / 1e6
