"""Date-part extraction (year, month, day, hour, day-of-week with 1 = Sunday)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_parts(ts, fmt: str | None = None) -> dict[str, Column]:
    """Parts of a timestamp column, or of a string column parsed with ``fmt``.

    Returns ``{"year", "month", "day", "hour", "dayOfWeek"}`` as int columns.
    ``dayofweek`` numbers Sunday as 1, the same numbering as a
    ``java.util.Calendar`` DAY_OF_WEEK.
    """
    t = _c(ts)
    if fmt is not None:
        # a zone-free timestamp: parts do not depend on the session time zone
        t = F.to_timestamp_ntz(t, F.lit(fmt))
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "dayOfWeek": F.dayofweek(t),
    }


def split_date_parts(date_str, sep: str = "-") -> dict[str, Column]:
    """``yyyy-MM-dd`` strings split into int year / month / day by position.

    Kept as a split (not a date parse) so that it accepts exactly what a
    positional split accepts; ``try_cast`` gives NULL instead of failing.
    """
    parts = F.split(_c(date_str), sep)
    # F.get: NULL for a missing position instead of an ANSI error
    return {
        "year": F.get(parts, 0).try_cast("int"),
        "month": F.get(parts, 1).try_cast("int"),
        "day": F.get(parts, 2).try_cast("int"),
    }
