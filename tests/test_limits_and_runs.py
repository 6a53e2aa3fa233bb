"""No size limits, whole ratios, fresh results per run, sweep rows kept."""
import pytest
from pyspark.sql import functions as F

from tabclass.operators.features import fit_vocabularies
from tabclass.operators.rows import invalid_rows
from tabclass.operators.split import hash_split, stratified_split
from tabclass.plans.results import sweep_speedup
from tabclass.sources.files import read_csv
from tabclass.sources.metrics_store import MetricsSink, metrics_frame


def test_many_categories(spark):
    df = spark.range(100_001).select(F.col("id").cast("string").alias("c"))
    assert len(fit_vocabularies(df, ["c"])["c"]) == 100_001


def test_many_strata(spark):
    df = spark.range(20_002).select("id", (F.col("id") % 10_001).alias("s"))
    out = stratified_split(df, "id", "s", 0.5)
    assert out.where("split = 'train'").count() == 10_001


def test_ratio_close_to_one(spark):
    out = hash_split(spark.range(1_000_000), "id", 0.99996).groupBy("split").count().collect()
    assert 10 < {r["split"]: r["count"] for r in out}["test"] < 100


def test_stratified_levels_agree(spark, monkeypatch):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("s"))
    once = stratified_split(df, "id", "s").orderBy("id").collect()
    monkeypatch.setattr("tabclass.operators.split.RANK_LIMIT", 0)
    assert stratified_split(df, "id", "s").orderBy("id").collect() == once


def test_differing_headers_raise(spark, tmp_dir):
    for name, head in (("a", "x,y"), ("b", "y,x")):
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(f"{head}\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, tmp_dir, schema="x string, y string").collect()


def _row(p, t, status="ok", dataset="d"):
    return {"dataset": dataset, "classifier": "c", "workers": 1, "partitions": p, "accuracy": 0.5, "total_time_s": t, "status": status}


def test_second_run_replaces_the_first(spark, tmp_dir):
    for t in (3.0, 4.0):
        sink = MetricsSink(spark, f"{tmp_dir}/runs", "csv")
        sink.start()
        sink.append(_row(1, t))
    assert [r.total_time_s for r in sink.read().collect()] == [4.0]


def test_sweep_keeps_runs_without_base_and_of_no_time(spark):
    rows = [_row(1, 8.0), _row(4, 2.0), _row(8, 0.0), _row(4, 1.0, "error"), _row(4, 5.0, dataset="other")]
    out = {(r.dataset, r.partitions): r.speedup for r in sweep_speedup(metrics_frame(spark, rows)).collect()}
    assert out == {("d", 1): 1.0, ("d", 4): 4.0, ("d", 8): None, ("other", 4): None}


def test_invalid_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "id int, x double")
    assert {r.id for r in invalid_rows(df, ["id", "x"]).collect()} == {2, 3}
