"""Wide profile: exact heavy values against brute force, odd columns, bounds."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabclass.operators.wide_profile import DISTINCT_ERROR, SKETCH_ERROR, wide_profile


def by_column(df, **kw):
    return {r["column"]: r for r in wide_profile(df, **kw).collect()}


@pytest.mark.parametrize("partitions", [1, 7])
def test_heavy_values_equal_brute_force(spark, partitions):
    rng = random.Random(3)
    # Ranks of falling frequency above a long tail: many values lie near the bar.
    values = [rng.choice([f"v{min(int(rng.paretovariate(0.6)), 20_000)}", f"t{rng.randrange(10**6)}", None]) for _ in range(40_000)]
    df = spark.createDataFrame([(v, i % 300, i) for i, v in enumerate(values)], "v string, m int, i long").repartition(partitions)
    for share in (0.002, 0.01, 0.2):
        got = by_column(df, share=share)
        count = Counter(v for v in values if v is not None)
        want = sorted(((v, n) for v, n in count.items() if n >= share * len(values)), key=lambda x: (-x[1], x[0]))
        assert [(h["value"], h["n"]) for h in got["v"]["heavy"]] == want
        assert got["v"]["nulls"] == values.count(None) and abs(got["v"]["distinct_estimate"] - len(count)) <= 4 * DISTINCT_ERROR * len(count)
        assert len(got["m"]["heavy"]) == (300 if share == 0.002 else 0) and got["i"]["heavy"] == []


def test_odd_columns_and_names(spark):
    rows = [(None, [1], float("nan"), "a", True)] * 3 + [(2, None, 1.0, None, False)]
    df = spark.createDataFrame(rows, "n int, `b.c` array<int>, x double, `q``r` string, rows boolean")
    got = by_column(df, share=0.3)
    assert [(r.column, r.nulls, r.min_value, r.max_value, r.distinct_estimate) for r in wide_profile(df, share=0.3).orderBy("position").collect()] == [
        ("n", 3, "2", "2", 1), ("b.c", 1, None, None, None), ("x", 0, "1.0", "NaN", 2), ("q`r", 1, "a", "a", 1), ("rows", 0, "false", "true", 2),
    ]
    assert [(h["value"], h["n"]) for h in got["x"]["heavy"]] == [("NaN", 3)] and got["n"]["heavy"] == []
    assert [r.column for r in wide_profile(df, ["x"]).collect()] == ["x"]


def test_one_value_all_nulls_and_no_rows(spark):
    got = by_column(spark.range(5000).select(F.lit("same").alias("a"), F.lit(None).cast("date").alias("b")))
    assert [tuple(h) for h in got["a"]["heavy"]] == [("same", 5000)] and got["b"]["heavy"] == [] and got["b"]["nulls"] == 5000
    empty = by_column(spark.createDataFrame([], "a int, b string"))
    assert {(r["rows"], r["nulls"], r["min_value"], r["distinct_estimate"], len(r["heavy"])) for r in empty.values()} == {(0, 0, None, 0, 0)}


def test_zeros_of_both_signs_are_one_value(spark):
    got = by_column(spark.createDataFrame([(0.0, 1.0), (-0.0, -0.0)], "x double, y float"))
    assert (got["x"]["min_value"], got["x"]["max_value"], got["y"]["min_value"], got["y"]["data_type"]) == ("0.0", "0.0", "0.0", "float")
    assert [tuple(h) for h in got["x"]["heavy"]] == [("0.0", 2)] and [tuple(h) for h in got["y"]["heavy"]] == [("0.0", 1), ("1.0", 1)]


def test_share_below_the_sketch_bound_is_refused(spark):
    with pytest.raises(ValueError):
        wide_profile(spark.range(3), share=2 * SKETCH_ERROR)
