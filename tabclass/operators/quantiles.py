"""Quantiles and quantile-binned targets.

``approx_quantiles`` is the reference's Greenwald-Khanna call (one pass,
relative error 0.01).  ``exact_quantiles`` returns the same value as SQL
``percentile_disc`` (the smallest value whose cumulative share reaches p, i.e.
the value of rank ceil(p * n)), without Spark's exact percentile aggregate,
which keeps every distinct value of a group in one task's memory.

How the exact form scales: every wanted rank keeps a candidate window
[lo, hi].  Each round runs one aggregation for ALL ranks together (per rank:
an approximate distinct count and two GK quantiles of the values inside its
window, bracketing the rank with a 2-epsilon margin), then one exact count of
the rows below and inside every bracket.  The window shrinks by
about 1 / (4 * epsilon) per round (250x at epsilon 1e-3), so 10^12 rows need
four or five rounds.  Only when the window holds at most ``max_collect``
distinct values are its (value, count) pairs brought to the driver; that bound
is checked, never assumed.  Every pass is a filtered scan of one column, so
the range filter and the column projection both reach the Parquet reader.
"""
from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

_Q = "_q"


def approx_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], relative_error: float = 0.01
) -> list[float]:
    """Greenwald-Khanna quantiles (``DataFrame.approxQuantile``); NULLs ignored."""
    _check_probabilities(probabilities)
    return df.approxQuantile(column, list(probabilities), relative_error)


def _check_probabilities(probabilities: Sequence[float]) -> None:
    if not probabilities:
        raise ValueError("need at least one probability")
    for p in probabilities:
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"probability must be in [0, 1], got {p}")


def _values(df: DataFrame, column: str) -> DataFrame:
    dtype = df.schema[column].dataType
    cond = F.col(_Q).isNotNull()
    if isinstance(dtype, (DoubleType, FloatType)):
        cond = cond & ~F.isnan(F.col(_Q))
    return df.select(F.col(column).alias(_Q)).where(cond)


def _kth_from_pairs(pairs, k: int, below: int, value_field: str = _Q):
    cum = below
    for row in pairs:
        cum += row["count"]
        if cum >= k:
            return row[value_field]
    raise RuntimeError("rank outside the candidate window")  # pragma: no cover


def _collect_pairs(win: DataFrame, max_collect: int):
    """(value, count) pairs of a window, ordered, or None if more than the bound."""
    pairs = win.groupBy(_Q).count().orderBy(_Q).limit(max_collect + 1).collect()
    return pairs if len(pairs) <= max_collect else None


@dataclass
class _Rank:
    """Search state of one wanted rank: its window [lo, hi] and what lies below."""

    k: int
    size: int
    lo: object = None
    hi: object = None
    below: int = 0
    bracket: tuple | None = None
    collect: bool = False
    margin: float = 0.0
    done: bool = False
    value: object = None

    def in_window(self) -> Column:
        cond = F.lit(True)
        if self.lo is not None:
            cond = cond & (F.col(_Q) >= F.lit(self.lo))
        if self.hi is not None:
            cond = cond & (F.col(_Q) <= F.lit(self.hi))
        return cond


def _narrow(base: DataFrame, ranks: list[_Rank], max_collect: int, relative_error: float) -> None:
    """Narrow every rank's window together; each step is ONE aggregation for all ranks."""
    accuracy = max(1, int(round(1.0 / relative_error)))
    while not all(r.done for r in ranks):
        # A. exact counts below / inside each bracket.
        counted = [i for i, r in enumerate(ranks) if not r.done and r.bracket is not None]
        if counted:
            aggs = []
            for i in counted:
                r = ranks[i]
                w = r.in_window()
                aggs += [
                    F.count(F.when(w & (F.col(_Q) < F.lit(r.bracket[0])), 1)).alias(f"lt{i}"),
                    F.count(F.when(w & (F.col(_Q) <= F.lit(r.bracket[1])), 1)).alias(f"le{i}"),
                ]
            row = base.agg(*aggs).first()
            for i in counted:
                r = ranks[i]
                q_lo, q_hi = r.bracket
                r.bracket = None
                new_below, new_upto = r.below + row[f"lt{i}"], r.below + row[f"le{i}"]
                if new_below < r.k <= new_upto and (new_upto - new_below) < r.size:
                    r.lo, r.hi, r.below, r.size = q_lo, q_hi, new_below, new_upto - new_below
                elif r.margin < 0.5:
                    r.margin *= 4.0  # bracket missed (not expected under the GK bound): widen
                else:  # pragma: no cover
                    raise RuntimeError("exact quantile did not converge")
        # B. windows small enough to bring back.  Windows bounded by their row
        #    count go together in one tagged aggregation; windows bounded only
        #    by an approximate distinct count are collected one by one, with
        #    the bound re-checked.
        small = [i for i, r in enumerate(ranks) if not r.done and r.size <= max_collect]
        if small:
            tags = F.filter(
                F.array(*[F.when(ranks[i].in_window(), F.lit(i)) for i in small]), lambda t: t.isNotNull()
            )
            rows = (
                base.select(F.explode(tags).alias("_w"), _Q)
                .groupBy("_w", _Q)
                .count()
                .orderBy("_w", _Q)
                .collect()
            )
            by_tag: dict[int, list] = {i: [] for i in small}
            for row in rows:
                by_tag[row["_w"]].append(row)
            for i in small:
                r = ranks[i]
                r.value, r.done = _kth_from_pairs(by_tag[i], r.k, r.below), True
        for i, r in enumerate(ranks):
            if not r.done and r.collect:
                pairs = _collect_pairs(base.where(r.in_window()), max_collect)
                r.collect = False
                if pairs is not None:
                    r.value, r.done = _kth_from_pairs(pairs, r.k, r.below), True
        # C. new GK brackets (and approximate distinct counts) for the rest.
        rest = [i for i, r in enumerate(ranks) if not r.done and r.bracket is None]
        if rest:
            aggs = []
            for i in rest:
                r = ranks[i]
                v = F.when(r.in_window(), F.col(_Q))
                local = (r.k - r.below) / r.size
                probes = [max(0.0, local - r.margin), min(1.0, local + r.margin)]
                aggs += [
                    F.approx_count_distinct(v).alias(f"nd{i}"),
                    F.percentile_approx(v, probes, accuracy).alias(f"br{i}"),
                ]
            row = base.agg(*aggs).first()
            for i in rest:
                r = ranks[i]
                if row[f"nd{i}"] <= max_collect // 2:
                    r.collect = True
                else:
                    r.bracket = tuple(row[f"br{i}"])


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    max_collect: int = 50_000,
    relative_error: float = 1e-3,
) -> list:
    """Exact ``percentile_disc`` values of ``column`` (NULL and NaN ignored).

    First pass: row count, approximate distinct count and a GK bracket around
    every wanted rank, in one aggregation.  If the whole column has few
    distinct values, one more job collects its (value, count) pairs and
    answers every probability; otherwise all ranks are narrowed together
    (see the module docstring), so the number of jobs does not grow with the
    number of probabilities.
    """
    _check_probabilities(probabilities)
    base = _values(df, column)
    accuracy = max(1, int(round(1.0 / relative_error)))
    margin = 2.0 * relative_error
    probes = []
    for p in probabilities:
        probes += [max(0.0, p - margin), min(1.0, p + margin)]
    stats = base.agg(
        F.count(F.lit(1)).alias("n"),
        F.approx_count_distinct(_Q).alias("nd"),
        F.percentile_approx(_Q, probes, accuracy).alias("br"),
    ).first()
    n = stats["n"]
    if n == 0:
        return [None for _ in probabilities]
    ks = [min(n, max(1, math.ceil(p * n))) for p in probabilities]
    if n <= max_collect or stats["nd"] <= max_collect // 2:
        pairs = _collect_pairs(base, max_collect)
        if pairs is not None:
            return [_kth_from_pairs(pairs, k, 0) for k in ks]
    br = stats["br"]
    ranks = [
        _Rank(k=k, size=n, bracket=(br[2 * i], br[2 * i + 1]), margin=margin) for i, k in enumerate(ks)
    ]
    _narrow(base, ranks, max_collect, relative_error)
    return [r.value for r in ranks]


def lazy_cut_points(df: DataFrame, column: str, probabilities: Sequence[float], relative_error: float = 0.01) -> list[Column]:
    """Approximate quantiles as columns: elements of a one-row subquery of ``df``."""
    x = F.col(column).cast("double")
    accuracy = F.lit(math.ceil(1 / max(relative_error, 1e-6)))
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    found = df.where(x.isNotNull() & ~F.isnan(x)).agg(F.percentile_approx(x, asked, accuracy).alias("cuts")).scalar()
    return [F.get(found, F.lit(i)) for i in range(len(probabilities))]


def quantile_cut_points(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    method: str = "approx",
    relative_error: float = 0.01,
) -> list:
    if method == "approx":
        return approx_quantiles(df, column, probabilities, relative_error)
    if method == "exact":
        return exact_quantiles(df, column, probabilities)
    raise ValueError(f"unknown quantile method {method!r}")


def bin_by_cut_points(column: str, cut_points: Sequence, labels: Sequence[str]) -> Column:
    """``value <= cut[0]`` -> labels[0], ``<= cut[1]`` -> labels[1], ..., else last.

    Ties at a cut point go to the lower bin.  NULL input falls to the last
    label, as ``when``/``otherwise`` does; callers drop NULL sources first.
    """
    if len(labels) != len(cut_points) + 1:
        raise ValueError("need exactly one more label than cut points")
    c = F.col(column)
    expr = None
    for cut, label in zip(cut_points, labels):
        cut = cut if isinstance(cut, Column) else F.lit(cut)
        expr = F.when(c <= cut, F.lit(label)) if expr is None else expr.when(c <= cut, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


# Fixed values that must equal the reference: tercile labels, low to high.
TERCILE_LABELS = ("Low", "Medium", "High")


def tercile_target(
    df: DataFrame,
    source: str,
    target: str,
    method: str = "approx",
    relative_error: float = 0.01,
    fit_df: DataFrame | None = None,
    drop_source: bool = True,
) -> tuple[DataFrame, list]:
    """Add ``target`` = Low / Medium / High by the terciles of ``source``.

    Cut points come from ``fit_df`` when given (e.g. training rows only), else
    from ``df`` itself, which is the reference's behaviour.  The source column
    is dropped by default, since it would leak the target.

    ``method="lazy"`` starts no job: the cut points are a scalar subquery of the plan
    (the same approximate quantiles), computed once by whatever job needs the target,
    and by none that doesn't.  The returned cut points are then columns, and without
    any value the target is the last label.
    """
    if method == "lazy":
        cuts = lazy_cut_points(fit_df if fit_df is not None else df, source, [1 / 3, 2 / 3], relative_error)
        out = df.withColumn(target, bin_by_cut_points(source, cuts, TERCILE_LABELS))
        return (out.drop(source) if drop_source else out), cuts
    cuts = quantile_cut_points(
        fit_df if fit_df is not None else df, source, [1 / 3, 2 / 3], method, relative_error
    )
    if any(c is None for c in cuts):
        raise ValueError(f"no non-null values in {source!r} to cut into terciles")
    out = df.withColumn(target, bin_by_cut_points(source, cuts, TERCILE_LABELS))
    if drop_source:
        out = out.drop(source)
    return out, cuts
