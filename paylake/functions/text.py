"""Text expressions: whitespace stripping, null tokens, title case, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylake.schemas import NULL_TOKENS, TYPE_LABELS, UNKNOWN_LABEL

_EDGE_WS = r"^\s+|\s+$"


def strip(c: Column) -> Column:
    """Strip leading/trailing whitespace (tabs and newlines too, unlike ``trim``)."""
    return F.regexp_replace(c, _EDGE_WS, "")


def strip_upper(c: Column) -> Column:
    return F.upper(strip(c))


def null_tokens(c: Column) -> Column:
    """Map the pandas CSV null tokens to null; other strings pass through."""
    return F.when(c.isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def zero_pad(n: Column, width: int) -> Column:
    """Decimal text of at least ``width`` digits; longer numbers keep every digit
    (``lpad`` alone would cut them)."""
    t = n.cast("string")
    return F.when(F.length(t) >= width, t).otherwise(F.lpad(t, width, "0"))


def initcap_words(c: Column) -> Column:
    """Title case that restarts after every non-alphanumeric character.

    ``BRONG-AHAFO`` -> ``Brong-Ahafo`` (Spark's ``initcap`` only restarts
    after spaces and would give ``Brong-ahafo``).
    """
    runs = F.regexp_extract_all(c, F.lit("([A-Za-z0-9]+|[^A-Za-z0-9]+)"), 1)
    cased = F.transform(
        runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))
    )
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.array_join(cased, ""))


def type_label(code: Column) -> Column:
    """Readable label of a transaction type code, ``Unknown`` when absent."""
    pairs = []
    for k, v in TYPE_LABELS.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(UNKNOWN_LABEL))


def money_text(x: Column, decimals: int = 2) -> Column:
    """``{x:,.<decimals>f}`` text of a double: grouped thousands, half-even on
    the exact binary value (``format_number`` has exactly that rounding)."""
    return F.format_number(x, decimals)


def plain_fixed(x: Column, decimals: int) -> Column:
    """``{x:.<decimals>f}`` text of a double (no thousands separators)."""
    return F.regexp_replace(F.format_number(x, decimals), ",", "")
