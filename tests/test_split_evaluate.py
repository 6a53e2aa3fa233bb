import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tabclass.operators.evaluate import confusion_matrix, evaluate, per_class_metrics, scores_frame
from tabclass.operators.split import hash_split, random_split, stratified_split, train_test_split

from conftest import SF01


def test_hash_split_partition_independent(spark):
    part = spark.read.parquet(f"{SF01}/part.parquet").select("p_partkey")
    one = {r.p_partkey: r.split for r in hash_split(part.coalesce(1), "p_partkey").collect()}
    eight = {r.p_partkey: r.split for r in hash_split(part.repartition(8), "p_partkey").collect()}
    assert one == eight
    share = sum(v == "train" for v in one.values()) / len(one)
    assert 0.75 < share < 0.85


def test_random_split_disjoint_complete_and_ratio_check(spark):
    df = spark.range(1000)
    tr, te = random_split(df)
    a, b = {r.id for r in tr.collect()}, {r.id for r in te.collect()}
    assert not a & b and len(a | b) == 1000
    with pytest.raises(ValueError):
        random_split(df, 1.0)


def test_stratified_exact_per_class(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a"] * 8 + ["b", "c"]) if i % 50 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, c string").repartition(5)
    out = stratified_split(df, "k", "c", 0.8)
    got = {(r.c, r.split): r.n for r in out.groupBy("c", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = {}
    for (c, _s), n in got.items():
        totals[c] = totals.get(c, 0) + n
    for c, n in totals.items():
        assert got.get((c, "train"), 0) == round(0.8 * n)
    # the chosen rows are the smallest hashes: same rows at any partitioning
    again = stratified_split(df.coalesce(1), "k", "c", 0.8)
    assert {r.k for r in out.where("split='train'").collect()} == {r.k for r in again.where("split='train'").collect()}


def test_train_test_split_methods(spark):
    df = spark.range(200).withColumn("c", (F.col("id") % 3).cast("string"))
    for m in ("hash", "stratified"):
        tr, te = train_test_split(df, method=m, keys=["id"], stratum="c")
        assert tr.count() + te.count() == 200 and "split" not in tr.columns


def test_metrics_equal_mllib(spark):
    rnd = random.Random(11)
    rows = [(float(rnd.randrange(3)), float(rnd.randrange(4))) for _ in range(500)]
    preds = spark.createDataFrame(rows, "label double, prediction double")
    ours = evaluate(preds)
    ev = MulticlassClassificationEvaluator()
    assert abs(ours.accuracy - ev.setMetricName("accuracy").evaluate(preds)) < 1e-12
    assert abs(ours.weighted_f1 - ev.setMetricName("f1").evaluate(preds)) < 1e-12
    sf = scores_frame(confusion_matrix(preds)).first()
    assert abs(sf.accuracy - ours.accuracy) < 1e-12 and abs(sf.weighted_f1 - ours.weighted_f1) < 1e-12
    pc = per_class_metrics(confusion_matrix(preds)).collect()
    assert all(0.0 <= r.f1 <= 1.0 for r in pc)


def test_stratified_second_level_and_duplicates(spark, monkeypatch):
    import tabclass.operators.split as sp

    rows = [(i, "a" if i % 3 else "b") for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, c string")
    one = {r.k: r.split for r in stratified_split(df, "k", "c").collect()}
    monkeypatch.setattr(sp, "RANK_LIMIT", 0)  # force the second level
    two = {r.k: r.split for r in sp.stratified_split(df, "k", "c").collect()}
    assert one == two
    # a hot duplicated key stays together and never needs one task per copy
    dup = spark.createDataFrame([(7, "a")] * 500 + [(i, "a") for i in range(100, 600)], "k long, c string")
    out = stratified_split(dup, "k", "c").groupBy("k").agg(F.countDistinct("split").alias("d"))
    assert out.where("d > 1").count() == 0


def test_null_keys(spark):
    rows = [(None if i % 10 == 0 else i, "a" if i % 2 else "b") for i in range(300)]
    df = spark.createDataFrame(rows, "k long, c string")
    flags = {r.split for r in hash_split(df, "k").where("k is null").collect()}
    assert len(flags) == 1  # all NULL keys land on one side
    out = stratified_split(df, "k", "c")
    assert out.count() == 300 and out.where("split is null").count() == 0
