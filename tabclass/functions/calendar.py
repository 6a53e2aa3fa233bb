"""Calendar features: parse, hour, day of week, year difference."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabclass.functions.casts import ColumnOrName, _col


def parse_timestamp(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Text -> timestamp; unparseable text gives NULL instead of an error.

    Without a format the text is read as a wall-clock ``timestamp_ntz``, so
    hour and day of week do not depend on the session time zone (a zoned
    parse would move times inside a daylight-saving gap).  With a format,
    ``try_to_timestamp`` is used, as the reference's ``to_timestamp``.
    """
    col = _col(c).cast("string")
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else col.try_cast("timestamp_ntz")


def hour_of_day(ts: ColumnOrName) -> Column:
    """0-23."""
    return F.hour(_col(ts)).cast("int")


def day_of_week(ts: ColumnOrName) -> Column:
    """1 = Sunday ... 7 = Saturday (the code's behaviour, not its 0-6 comment)."""
    return F.dayofweek(_col(ts)).cast("int")


def year_diff(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Difference of calendar years; month and day are ignored (the 'age' rule)."""
    return (F.year(_col(later)) - F.year(_col(earlier))).cast("int")
