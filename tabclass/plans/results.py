"""Operators over metrics rows (small tables; all plain DataFrame code)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_frame(spark, rows: list[dict]) -> DataFrame:
    """(dataset, classifier, partitions, label, prediction, n) from experiment rows."""
    cells = [
        (r["dataset"], r["classifier"], r.get("partitions"), float(lab), float(pred), int(n))
        for r in rows
        for lab, pred, n in (r.get("confusion") or [])
    ]
    return spark.createDataFrame(
        cells, "dataset string, classifier string, partitions int, label double, prediction double, n bigint"
    )


def per_class_report(spark, rows: list[dict]) -> DataFrame:
    """Per-class support, precision, recall and F1 for every experiment."""
    from tabclass.operators.evaluate import per_class_metrics

    return per_class_metrics(confusion_frame(spark, rows), by=("dataset", "classifier", "partitions"))


def total_time(results: DataFrame) -> DataFrame:
    """total_time_s = train_time_s + predict_time_s."""
    return results.withColumn("total_time_s", F.col("train_time_s") + F.col("predict_time_s"))


def time_by_classifier(results: DataFrame) -> DataFrame:
    """Sum of total_time_s per classifier, largest first (successful rows only)."""
    ok = results.where(F.col("status").isNull() | (F.col("status") == "ok")) if "status" in results.columns else results
    return (
        ok.groupBy("classifier")
        .agg(F.sum("total_time_s").alias("total_time_s"), F.count(F.lit(1)).alias("experiments"))
        .orderBy(F.col("total_time_s").desc(), F.col("classifier"))
    )


def sweep_speedup(results: DataFrame, base_workers: int = 1, base_partitions: int = 1) -> DataFrame:
    """Speed-up of each run against the serial base of the same (dataset, classifier).

    speedup = base total_time_s / total_time_s.  Failed runs are left out; a
    base that ran more than once counts with its mean; a run without a base, or
    of no time, keeps its row with a NULL speed-up.
    """
    ok = results.where(F.coalesce(F.col("status") == "ok", F.lit(True))) if "status" in results.columns else results
    base = (
        ok.where((F.col("workers") == base_workers) & (F.col("partitions") == base_partitions))
        .groupBy("dataset", "classifier")
        .agg(F.avg("total_time_s").alias("base_time_s"), F.avg("accuracy").alias("base_accuracy"))
    )
    return ok.join(base, ["dataset", "classifier"], "left").select(
        "dataset", "classifier", "workers", "partitions", "total_time_s", "base_time_s",
        F.try_divide("base_time_s", "total_time_s").alias("speedup"),
        (F.col("accuracy") - F.col("base_accuracy")).alias("accuracy_delta"),
    )
