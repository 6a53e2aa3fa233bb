"""Quantiles from stored sketches that merge.

``approxQuantile`` is one job whose result can't be combined with another's.  A KLL
sketch is a small binary column: made by an ordinary aggregate, for each group, with
map-side combine; stored beside its count; merged later with those of other files or
runs; and only then asked for quantiles.  Merging loses nothing: the rank error of
``sketch_size`` holds for the merged sketch.

NULL and NaN values aren't counted.  A group without values has no sketch row.
The error holds with 99 % confidence for a single rank; groups of up to the sketch's
size are exact.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabclass.operators.quantiles import TERCILE_LABELS

#: Groups whose cut points are broadcast; more are joined by a shuffle.
BROADCAST_GROUPS = 10_000
LEAST_SIZE, MOST_SIZE = 8, 65_535


def sketch_size(error: float) -> int:
    """The size k whose rank error is at most ``error`` (2.296 / k^0.9723)."""
    if not 0 < error < 1:
        raise ValueError(f"a rank error lies between 0 and 1, not {error}")
    k = math.ceil((2.296 / error) ** (1 / 0.9723))
    if k > MOST_SIZE:
        raise ValueError(f"no sketch is as exact as {error}; use exact_quantiles")
    return max(LEAST_SIZE, k)


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str] = (), error: float = 0.01) -> DataFrame:
    """(*by, n, sketch): one row a group."""
    x = F.col(f"`{value}`").cast("double")
    rows = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_x", F.lit(sketch_size(error))).alias("sketch")
    ).where("n > 0")


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row for each group of ``by``, a part of the columns the sketches were made by."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")).where("n > 0")


def sketch_quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """``sketches`` with ``quantiles``, an array in the order of ``probabilities``."""
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    return sketches.withColumn("quantiles", F.kll_sketch_get_quantile_double("sketch", asked)).drop("sketch")


def grouped_bins(
    df: DataFrame, source: str, target: str, sketches: DataFrame, by: Sequence[str], labels: Sequence[str] = TERCILE_LABELS
) -> DataFrame:
    """``df`` with ``target``: the label of the bin of ``source`` among the quantiles
    of its own group, which cut as many bins as there are labels.  A value on a cut
    belongs to the lower bin.  NULL, NaN, and groups without a sketch have no bin."""
    steps = len(labels)
    cuts = sketch_quantiles(sketches, [i / steps for i in range(1, steps)])
    names = [f"_by{i}" for i in range(len(by))]
    cuts = cuts.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(by, names)], F.col("quantiles").alias("_cuts"))
    if len(cuts.take(BROADCAST_GROUPS + 1)) <= BROADCAST_GROUPS:
        cuts = F.broadcast(cuts)
    same = F.lit(True)
    for c, n in zip(by, names):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(n))
    x = F.col(f"`{source}`").cast("double")
    out = df.join(cuts, same, "left")
    bin_ = F.when(x.isNull() | F.isnan(x) | F.col("_cuts").isNull(), None)
    for i in range(steps - 1):
        bin_ = bin_.when(x <= F.get("_cuts", F.lit(i)), labels[i])
    return out.withColumn(target, bin_.otherwise(labels[-1])).drop("_cuts", *names)
