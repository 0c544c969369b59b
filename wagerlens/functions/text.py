"""Text clean-up, keys and message text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode calls white space; plain trim() strips only the space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: stands for NULL inside a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

KEY_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def trimmed(col: Column | str) -> Column:
    return F.btrim(F.col(col) if isinstance(col, str) else col, F.lit(WHITESPACE))


def lower_trimmed(col: Column | str) -> Column:
    return F.lower(trimmed(col))


def upper_trimmed(col: Column | str) -> Column:
    return F.upper(trimmed(col))


def key_time(col: Column | str) -> Column:
    """Timestamp text with a fixed width, so that keys do not depend on the fraction."""
    return F.date_format(col, KEY_TIME_FORMAT)


def surrogate_key(parts: Sequence[Column | str]) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(
        F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(NULL_KEY_PART)) for c in cols])
    )


def money_text(col: Column | str) -> Column:
    """Decimal as text without trailing zeros: 100.50 -> 100.5, 100.00 -> 100."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c.cast("string"), r"\.?0+$", "")


def list_text(items: Column, sep: str = ", ") -> Column:
    """Sorted list as one string."""
    return F.array_join(F.sort_array(items), sep)
