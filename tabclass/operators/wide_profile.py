"""Profile of every column of a wide table in two passes, however many columns.

The first pass is one aggregation without a shuffle of rows: nulls, least and
greatest value, a distinct-count sketch and a frequent-items sketch of each
column.  The second counts the sketches' candidates exactly, so which values are
reported as heavy, and how often they occur, does not depend on a sketch.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values a frequent-items sketch keeps, and the relative error of its counts: a
#: map of m places errs by 3.5 / m of the rows at most, and three quarters are used.
TRACKED = 3072
SKETCH_ERROR = 3.5 * 0.75 / TRACKED
#: Relative standard deviation of the distinct counts.
DISTINCT_ERROR = 0.02

#: Types whose values are counted; others have no range and no heavy values.
COUNTED = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

SCHEMA = (
    "position int, column string, data_type string, rows bigint, nulls bigint, min_value string, max_value string, "
    "distinct_estimate bigint, heavy array<struct<value: string, n: bigint>>"
)


def _values(field: T.StructField) -> str:
    """SQL of a column's values; adding 0 makes one value of the two signs of zero."""
    quoted = "`" + field.name.replace("`", "``") + "`"
    return f"cast({quoted} + 0D AS {field.dataType.simpleString()})" if isinstance(field.dataType, T.FractionalType) and not isinstance(field.dataType, T.DecimalType) else quoted


def _candidates(values: str, share: float) -> Column:
    """Texts of the values that may hold ``share`` of the rows: every one that does
    is among them, since its count is above twice the sketch's error, and no more
    than 1 / (share - error) values can be estimated as high."""
    most = math.ceil(1 / (share - SKETCH_ERROR)) + 1  # and null
    found = F.expr(f"approx_top_k({values}, {most}, {TRACKED})")
    return F.filter(F.transform(found, lambda x: x["item"].cast("string")), lambda x: x.isNotNull())


def wide_profile(df: DataFrame, columns: Sequence[str] | None = None, share: float = 0.01) -> DataFrame:
    """One row for each of ``columns`` (all by default): position, column,
    data_type, rows, nulls, min_value, max_value, distinct_estimate, heavy.

    Values are given as text.  ``heavy`` lists the values that hold at least
    ``share`` of the table's rows, with exact counts, most frequent first, ties by
    value.  ``distinct_estimate`` leaves nulls out and errs by DISTINCT_ERROR (one
    standard deviation).  -0.0 counts as 0.0.  NaN counts as a value, greater than all others.  A
    column of a nested or binary type has only its nulls counted.  An empty table
    has zeros, null ranges and no heavy values.

    To the driver come one row, and for each column at most 1 / share values or
    candidates.  ``share`` must exceed twice SKETCH_ERROR, or a heavy value could be missed.
    """
    if not 2 * SKETCH_ERROR < share <= 1:
        raise ValueError(f"share must be above {2 * SKETCH_ERROR:.4f} and at most 1")
    names = list(df.columns if columns is None else columns)
    fields = [df.schema[n] for n in names]
    values = [_values(f) for f in fields]
    counted = [isinstance(f.dataType, COUNTED) for f in fields]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(names)):
        c = F.expr(values[i])
        aggs.append(F.count(c).alias(f"filled_{i}"))
        if counted[i]:
            aggs += [
                F.min(c).cast("string").alias(f"min_{i}"), F.max(c).cast("string").alias(f"max_{i}"),
                F.approx_count_distinct(c, DISTINCT_ERROR).alias(f"distinct_{i}"), _candidates(values[i], share).alias(f"top_{i}"),
            ]
    first = df.agg(*aggs).first()
    rows = first["rows"]
    heavy = _exact_counts(df, {i: first[f"top_{i}"] for i in range(len(names)) if counted[i] and first[f"top_{i}"]}, values, share * rows)
    out = []
    for i, (name, f) in enumerate(zip(names, fields)):
        known = [first[f"{k}_{i}"] if counted[i] else None for k in ("min", "max", "distinct")]
        out.append((i, name, f.dataType.simpleString(), rows, rows - first[f"filled_{i}"], *known, heavy.get(i, [])))
    return df.sparkSession.createDataFrame(out, SCHEMA)


def _exact_counts(df: DataFrame, candidates: dict[int, list[str]], values: Sequence[str], least: float) -> dict[int, list[tuple[str, int]]]:
    """(value, rows) of the candidates of each column position with at least
    ``least`` rows.  Only cells that hold a candidate become rows, and those are
    counted before the shuffle, so that it carries one row a task and candidate."""
    if not candidates:
        return {}
    cells = [
        F.when(F.expr(values[i]).cast("string").isin(texts), F.struct(F.lit(i).alias("at"), F.expr(values[i]).cast("string").alias("value")))
        for i, texts in candidates.items()
    ]
    hits = df.select(F.explode(F.array_compact(F.array(*cells))).alias("hit")).select("hit.at", "hit.value")
    counts = hits.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    out: dict[int, list[tuple[str, int]]] = {}
    for r in counts.orderBy("at", F.desc("n"), "value").collect():
        out.setdefault(r["at"], []).append((r["value"], r["n"]))
    return out
