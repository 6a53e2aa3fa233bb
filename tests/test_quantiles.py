import random

import pytest

from tabclass.operators.quantiles import (
    approx_quantiles,
    bin_by_cut_points,
    exact_quantiles,
    tercile_target,
)


def _disc(spark, df, col, p):
    df.createOrReplaceTempView("qv")
    return spark.sql(f"SELECT percentile_disc({p}) WITHIN GROUP (ORDER BY {col}) AS q FROM qv").first().q


@pytest.mark.parametrize("max_collect", [10, 50_000])
def test_exact_equals_percentile_disc(spark, max_collect):
    rnd = random.Random(7)
    # heavy ties: one value holds a third of the rows, plus a long tail
    vals = [5.0] * 700 + [rnd.uniform(0, 100) for _ in range(1400)] + [None] * 30
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(4)
    probs = [0.0, 0.1, 1 / 3, 0.5, 2 / 3, 0.99, 1.0]
    got = exact_quantiles(df, "x", probs, max_collect=max_collect, relative_error=0.01)
    want = [_disc(spark, df.where("x is not null"), "x", p) for p in probs]
    assert got == want


def test_exact_on_integers_and_empty(spark):
    df = spark.createDataFrame([(i % 37,) for i in range(1000)], "x int")
    assert exact_quantiles(df, "x", [0.5], max_collect=5) == [_disc(spark, df, "x", 0.5)]
    empty = spark.createDataFrame([], "x double")
    assert exact_quantiles(empty, "x", [0.5]) == [None]


def test_approx_within_rank_error(spark):
    n = 5000
    df = spark.createDataFrame([(float(i),) for i in range(n)], "x double")
    q1, q2 = approx_quantiles(df, "x", [1 / 3, 2 / 3], 0.01)
    assert abs(q1 - n / 3) <= 0.01 * n + 1 and abs(q2 - 2 * n / 3) <= 0.01 * n + 1


def test_ties_at_cut_go_low_and_all_equal_is_low(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,), (4.0,), (5.0,)], "s double")
    out, cuts = tercile_target(df, "s", "t", method="exact", drop_source=False)
    m = {r.s: r.t for r in out.collect()}
    assert cuts == [_disc(spark, df, "s", 1 / 3), _disc(spark, df, "s", 2 / 3)] == [2.0, 3.0]
    assert m[2.0] == "Low" and m[3.0] == "Medium" and m[4.0] == "High"
    same = spark.createDataFrame([(7.0,)] * 5, "s double")
    out2, _ = tercile_target(same, "s", "t", method="exact")
    assert {r.t for r in out2.collect()} == {"Low"} and "s" not in out2.columns


def test_bin_needs_matching_labels():
    with pytest.raises(ValueError):
        bin_by_cut_points("x", [1, 2], ["a", "b"])
