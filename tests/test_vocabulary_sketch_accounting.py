"""Vocabulary tables, mergeable quantile sketches and row accounts."""
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import functions as F

from tabclass.operators import vocabulary as vocabulary_module
from tabclass.operators.accounting import RowAccount, account_frame
from tabclass.operators.features import build_features, category_counts, fit_vocabularies
from tabclass.operators.quantile_sketch import grouped_bins, merge_sketches, quantile_sketches, sketch_quantiles, sketch_size
from tabclass.operators.rows import valid
from tabclass.operators.vocabulary import fit_vocabulary_table, index_columns
from tabclass.sources.leases import leased_table, leases, release


def table(spark, n=3000):
    rng = random.Random(n)
    value = lambda: rng.choice([None, "hot", "hot", "hot", "", " ", f"v{rng.randrange(400)}", f"é{rng.randrange(9)}"])
    return spark.createDataFrame([(i, value(), rng.choice([1, 2, 2, None]), "clash") for i in range(n)], "id long, `a.b` string, c int, value string").repartition(7)


def ranked(values):
    counts = Counter(str(v) for v in values if v is not None)
    return {v: i for i, v in enumerate(sorted(counts, key=lambda v: (-counts[v], v.encode())))}


@pytest.mark.parametrize("broadcast, heavy", [(100_000, 1000), (0, 1000), (0, 3), (0, 10**9)])
def test_index_equals_plain_ranking(spark, monkeypatch, broadcast, heavy):
    monkeypatch.setattr(vocabulary_module, "BROADCAST_VALUES", broadcast)
    monkeypatch.setattr(vocabulary_module, "HEAVY", heavy)
    df = table(spark)
    vocab = fit_vocabulary_table(df, ["a.b", "c", "value"])
    rows = index_columns(df, vocab, ["a.b", "c", "value"]).collect()
    assert len(rows) == 3000
    for column in ("a.b", "c", "value"):
        rank = ranked(r[column] for r in rows)
        assert all(r[f"{column}_idx"] == rank.get(str(r[column]) if r[column] is not None else None, len(rank)) for r in rows)
    release(vocab)


def test_unseen_values_and_empty_tables(spark):
    df = table(spark, 300)
    vocab = fit_vocabulary_table(df, ["c"])
    new = spark.createDataFrame([(1, 7), (2, None), (3, 2)], "id long, c int")
    assert {r.id: r.c_idx for r in index_columns(new, vocab, ["c"]).collect()} == {1: 2.0, 2: 2.0, 3: 0.0}
    none = fit_vocabulary_table(df.limit(0), ["c"])
    assert none.count() == 0 and {r.c_idx for r in index_columns(new, none, ["c"]).collect()} == {0.0}
    assert index_columns(df.limit(0), vocab, ["c"]).count() == 0


def test_index_feeds_the_one_hot_encoder_like_the_indexer(spark):
    df = table(spark, 500).withColumnRenamed("a.b", "a").where("a IS NULL OR a <> ''")  # MLlib takes no unnamed category
    df = df.withColumn("y", (F.col("id") % 2).cast("string")).withColumn("x", F.lit(1.0))
    vocab = fit_vocabulary_table(df, ["a"])
    indexed = index_columns(df, vocab, ["a"])
    ours = OneHotEncoder(inputCols=["a_idx"], outputCols=["a_ohe"]).fit(indexed.limit(0)).transform(indexed)
    theirs, _ = build_features(df, "y", ["x"], ["a"])
    a = {r.id: r.a_ohe for r in ours.select("id", "a_ohe").collect()}
    assert a == {r.id: r.a_ohe for r in theirs.select("id", "a_ohe").collect()}


def test_vocabulary_equals_the_collected_one(spark):
    df = table(spark)
    ours = {(r["column"], r["value"]): r["idx"] for r in category_counts(df, ["a.b", "c"]).collect()}
    theirs = fit_vocabularies(df.withColumnRenamed("a.b", "ab"), ["ab", "c"])
    assert ours == {({"ab": "a.b"}.get(c, c), v): i for c, vs in theirs.items() for i, v in enumerate(vs)}


def test_a_million_categories_stay_in_spark(spark, monkeypatch):
    monkeypatch.setattr(vocabulary_module, "BROADCAST_VALUES", 1000)
    df = spark.range(1_500_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("c"))
    vocab = fit_vocabulary_table(df, ["c"])
    out = index_columns(df, vocab, ["c"]).agg(F.count("*").alias("n"), F.countDistinct("c_idx").alias("d"), F.max("c_idx").alias("m"), F.sum((F.col("c_idx") == 0).cast("int")).alias("hot")).first()
    assert (out.n, out.d, out.m, out.hot) == (1_500_000, 1_000_001, 1_000_000.0, 500_000)
    release(vocab)


def test_fitting_leaves_only_the_vocabulary(spark):
    before = len(leases(spark))
    vocab = fit_vocabulary_table(table(spark, 50), ["c"])
    assert len(leases(spark)) == before + 1
    release(vocab)
    assert len(leases(spark)) == before


# ---------------------------------------------------------------- sketches
def rank_error(values, p, found):
    values = np.sort(values)
    low, high = np.searchsorted(values, found, "left") / len(values), np.searchsorted(values, found, "right") / len(values)
    return 0.0 if low <= p <= high else min(abs(low - p), abs(high - p))


@pytest.mark.parametrize("error", [0.05, 0.01])
def test_merged_sketches_keep_the_error(spark, error):
    rng = np.random.default_rng(3)
    data = {"skewed": rng.exponential(size=30_000), "ties": rng.integers(0, 3, 20_000).astype(float), "few": np.array([5.0, 1.0, 9.0])}
    rows = [(g, i % 6, float(x)) for g, xs in data.items() for i, x in enumerate(xs)] + [("few", 0, None), ("few", 1, float("nan")), ("none", 0, None)]
    df = spark.createDataFrame(rows, "g string, part int, x double").repartition(5)
    stored = leased_table(quantile_sketches(df, "x", ["g", "part"], error), "sketches")  # as of six runs
    probs = [0.01, 1 / 3, 0.5, 2 / 3, 0.99]
    found = {r.g: r for r in sketch_quantiles(merge_sketches(stored, ["g"]), probs).collect()}
    assert set(found) == set(data)  # a group without values has no sketch
    for g, xs in data.items():
        assert found[g].n == len(xs)
        assert all(rank_error(xs, p, q) <= 2 * error for p, q in zip(probs, found[g].quantiles))
    assert found["few"].quantiles[2] == 5.0
    release(stored)


def test_sketch_of_a_whole_column_and_of_nothing(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    q = sketch_quantiles(merge_sketches(quantile_sketches(df, "x")), [0.5]).first()
    assert q.n == 1000 and abs(q.quantiles[0] - 500) <= 10
    assert merge_sketches(quantile_sketches(df.limit(0), "x")).count() == 0


def test_sketch_size():
    assert sketch_size(0.05) < sketch_size(0.01) < sketch_size(0.001)
    for bad in (0, 1, -1, 1e-9):
        with pytest.raises(ValueError):
            sketch_size(bad)


@pytest.mark.parametrize("groups", [10_000, 0])
def test_grouped_terciles(spark, monkeypatch, groups):
    monkeypatch.setattr("tabclass.operators.quantile_sketch.BROADCAST_GROUPS", groups)
    rows = [(g, float(i)) for g in ("a", None) for i in range(9)] + [("b", None), ("b", float("nan")), ("a", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    out = grouped_bins(df, "x", "bin", quantile_sketches(df, "x", ["g"]), ["g"])
    got = Counter((r.g, r.bin) for r in out.collect())
    assert sum(got.values()) == len(rows) and got[("b", None)] == 2 and got[("a", None)] == 1
    for g in ("a", None):
        assert [got[(g, b)] for b in ("Low", "Medium", "High")] == [3, 3, 3]


# ---------------------------------------------------------------- accounts
def test_accounts_count_in_the_job_that_runs_anyway(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else float(i)) for i in range(100)], "id long, x double")
    account = RowAccount("t")
    plan = account.mark(account.mark(account.mark(df, "read").where("id >= 10"), "kept"), "usable", valid(["x"]))
    with pytest.raises(RuntimeError, match="no job"):
        account.counts(wait_s=0.1)
    assert str(plan._jdf.queryExecution().executedPlan()).count("Scan") == 1  # marks add no scan
    release(leased_table(plan, "accounted"))
    assert account.counts() == {"read": 100, "kept": 90, "usable": 72}
    assert [(r.step, r.rows, r.dropped) for r in account_frame(spark, [account]).orderBy("position").collect()] == [("read", 100, None), ("kept", 90, 10), ("usable", 72, 18)]


def test_accounts_of_no_rows_and_repeated_steps(spark):
    account = RowAccount("empty")
    df = account.mark(spark.range(0), "read")
    with pytest.raises(ValueError, match="marked"):
        account.mark(df, "read")
    df.write.format("noop").mode("overwrite").save()
    assert account.counts() == {"read": 0}


# ------------------------------------------------- many classes, lazy cuts
def test_scores_by_class_equal_those_by_cell(spark, monkeypatch):
    from tabclass.operators.evaluate import class_counts, class_scores, confusion_matrix, evaluate, per_class_metrics

    rng = random.Random(6)
    preds = spark.createDataFrame([(float(rng.randrange(30)), float(rng.choice([1, 2, rng.randrange(40)]))) for _ in range(2000)], "label double, prediction double")
    want = evaluate(preds)
    for got in (evaluate(preds, method="classes"), evaluate(preds, method="mllib")):
        assert abs(got.accuracy - want.accuracy) < 1e-12 and abs(got.weighted_f1 - want.weighted_f1) < 1e-12
    cells = {r["class"]: (r.support, r.predicted, r.tp) for r in per_class_metrics(confusion_matrix(preds)).collect()}
    assert cells == {r["class"]: (r.support, r.predicted, r.tp) for r in class_counts(preds).collect()}
    assert class_scores(class_counts(preds)).first().classes == 30
    monkeypatch.setattr("tabclass.operators.evaluate.MAX_CELLS", 10)
    few = evaluate(preds)  # too many cells: by class
    assert few.cells == () and abs(few.weighted_f1 - want.weighted_f1) < 1e-12 and few.rows == 2000


def test_scores_of_a_hundred_thousand_classes_and_of_none(spark):
    from tabclass.operators.evaluate import class_counts, class_scores, evaluate

    preds = spark.range(300_000).select((F.col("id") % 100_000).cast("double").alias("label"), F.when(F.col("id") < 100_000, F.col("id")).otherwise(-1).cast("double").alias("prediction"))
    r = class_scores(class_counts(preds)).collect()
    assert len(r) == 1 and (r[0].n, r[0].classes) == (300_000, 100_000)
    assert abs(r[0].accuracy - 1 / 3) < 1e-12 and abs(r[0].weighted_f1 - 2 / 4) < 1e-12
    none = evaluate(preds.limit(0), method="classes")
    assert none.rows == 0 and none.accuracy != none.accuracy


def test_lazy_cut_points_start_no_job_and_cut_alike(spark):
    from tabclass.operators.quantiles import tercile_target

    df = spark.range(3000).select("id", ((F.col("id") * 7919) % 3000).cast("double").alias("x"))
    sc = spark.sparkContext
    sc.setJobGroup("lazy", "lazy")
    out, _ = tercile_target(df, "x", "t", "lazy")
    assert out.schema["t"].dataType.simpleString() == "string" and out.drop("t").count() == 3000
    plan = out.drop("t")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_approx" not in plan  # nothing that doesn't need the target computes it
    shares = {r.t: r["count"] for r in out.groupBy("t").count().collect()}
    assert set(shares) == {"Low", "Medium", "High"} and all(abs(n - 1000) <= 60 for n in shares.values())
    fit, _ = tercile_target(df, "x", "t", "lazy", fit_df=df.where("x < 300"))
    assert fit.where("t = 'High'").count() > 2700
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_fraud_keys_keep_their_types(spark):
    from tabclass.plans import standins as S
    from tabclass.plans.recipes import normalize_fraud

    from conftest import SF001

    raw = S.fraud_raw(spark, SF001).withColumn("key", F.col(S.FRAUD_KEY).cast("decimal(20,2)")).withColumn("day", F.lit("2020-01-02").cast("date"))
    out = normalize_fraud(raw, keep=("key", "day"))
    assert [out.schema[c].dataType.simpleString() for c in ("key", "day")] == ["decimal(20,2)", "date"] and out.count() > 0
