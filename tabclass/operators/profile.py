"""Dataset check ("smoke"): size, schema and a few rows, without training."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def schema_frame(spark: SparkSession, df: DataFrame, target: str | None = None) -> DataFrame:
    """(position, column, data_type, nullable, is_target) from the analysed plan (no job)."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable, f.name == target)
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "position int, column string, data_type string, nullable boolean, is_target boolean"
    )


def profile_table(df: DataFrame, dataset: str, target: str | None = None) -> DataFrame:
    """One row: dataset, rows, columns, target, target_nulls (one aggregation job)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if target is not None:
        aggs.append(F.count(F.when(F.col(target).isNull(), 1)).alias("target_nulls"))
    else:
        aggs.append(F.lit(None).cast("bigint").alias("target_nulls"))
    return df.agg(*aggs).select(
        F.lit(dataset).alias("dataset"),
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.lit(target).cast("string").alias("target"),
        "target_nulls",
    )


def sample_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by a key: a stable version of ``show(5)``.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject, a per-partition
    top-n followed by a merge of n rows per partition, not a full sort.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    return df.orderBy(*order_by).limit(n)
