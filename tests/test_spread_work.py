"""Work that must be dealt over many tasks, whatever files the input comes in."""
from pyspark.sql import functions as F

from tabclass.operators import partitioning
from tabclass.operators.partitioning import spread_rows
from tabclass.plans import queries as Q
from tabclass.plans.experiments import ExperimentDataset, RunConfig, prepare
from tabclass.sources.leases import release


def sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_rows_of_one_partition_are_dealt_evenly_and_always_alike(spark, monkeypatch):
    monkeypatch.setattr(partitioning, "LEAST_ROWS", 10)
    df = spark.range(0, 1000, 1, 1).select((F.col("id") % 100).alias("a.b"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("c"))
    out = spread_rows(df, 4)
    assert sizes(out) == [250] * 4
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert out.collect() == spread_rows(df, 4).collect()
    empty_ones = df.union(df.where("c < 0")).union(df.where("c < 0")).union(df.where("c < 0"))
    assert sizes(spread_rows(empty_ones, 4)) == [250] * 4


def test_small_and_even_tables_stay_as_they_are(spark, monkeypatch):
    small = spark.range(0, 100, 1, 1)
    assert spread_rows(small, 4) is small
    monkeypatch.setattr(partitioning, "LEAST_ROWS", 10)
    even = spark.range(0, 100, 1, 4)
    assert spread_rows(even, 4) is even
    assert spread_rows(small.where("id < 0"), 4).count() == 0


def test_no_partition_is_larger_than_allowed(spark, monkeypatch):
    monkeypatch.setattr(partitioning, "LEAST_ROWS", 10)
    monkeypatch.setattr(partitioning, "MOST_ROWS", 100)
    assert max(sizes(spread_rows(spark.range(0, 1000, 1, 1), 2))) <= 100


def test_experiments_fit_on_all_cores(spark, monkeypatch):
    monkeypatch.setattr(partitioning, "LEAST_ROWS", 10)
    rows = spark.range(0, 400, 1, 1).select("id", (F.col("id") % 7).alias("x"), F.when(F.col("id") % 2 > 0, "a").otherwise("b").alias("label_"))
    ds = ExperimentDataset("one_partition", lambda s: rows, "label_", keys=("id",), numeric=["x"], categorical=[])
    table, _ = prepare(spark, ds, RunConfig())
    assert table.count() == 400 and len(sizes(table)) > 1
    release(table)


def test_models_of_the_part_table_fit_on_all_cores(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(partitioning, "LEAST_ROWS", 10)
    part = spark.range(1, 601, 1, 1).selectExpr(
        "id AS p_partkey", "'n' AS p_name", "concat('Brand#', id % 5) AS p_brand", "concat('T', id % 7) AS p_type",
        "cast(id % 50 AS int) AS p_size", "cast(900 + id AS double) AS p_retailprice",
    )
    part.write.parquet(f"{tmp_dir}/part.parquet")
    train, test = Q._salary_train_test(spark, tmp_dir)
    assert len(sizes(train)) > 1 and len(sizes(test)) > 1
