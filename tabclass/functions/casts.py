"""Safe casts and text clean-up (JVM-side column expressions).

Spark 4 runs with ANSI mode on, where ``cast('NULL' as int)`` throws.  The
reference relied on the old behaviour, where a bad value becomes NULL.  We get
the same result without touching the global setting by using ``try_cast``:

* text -> int goes through double first, so ``'3.9'`` gives 3 (truncation),
  as the old cast did; out-of-range and NaN give NULL;
* text -> bigint is tried directly first, so values above 2**53 keep every
  digit, and only falls back to the double route for text like ``'3.9'``;
* anything -> double is a plain ``try_cast``.

A text column that holds only true and false is made boolean when it is loaded
(``tabclass.sources.catalog``), so that its casts give 1 and 0; among other texts,
``True`` is a bad number and becomes NULL.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c: ColumnOrName) -> Column:
    return _col(c).try_cast("double")


def safe_int(c: ColumnOrName, source_type: DataType | None = None) -> Column:
    col = _col(c)
    if source_type is not None and not isinstance(source_type, StringType):
        return col.try_cast("int")
    return col.try_cast("double").try_cast("int")


def safe_long(c: ColumnOrName, source_type: DataType | None = None) -> Column:
    col = _col(c)
    if source_type is not None and not isinstance(source_type, StringType):
        return col.try_cast("bigint")
    return F.coalesce(col.try_cast("bigint"), col.try_cast("double").try_cast("bigint"))


def trimmed_string(c: ColumnOrName) -> Column:
    """``trim(cast(c as string))``: strips spaces only, not tabs or newlines."""
    return F.trim(_col(c).cast("string"))

