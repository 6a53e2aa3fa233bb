"""Dataset check ("smoke"): load and normalise each dataset, report its size,
schema and first rows, without training.

Every step of a dataset, including the counting and the sample, runs inside
that dataset's guard, so one broken file is reported and the others still run.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabclass.operators.profile import profile_table, sample_rows, schema_frame
from tabclass.sources.catalog import DatasetSpec

PROFILE_SCHEMA = (
    "dataset string, size_category string, path string, rows bigint, columns int, "
    "target string, target_nulls bigint, status string, error string"
)


@dataclass
class SmokeReport:
    profiles: DataFrame
    schemas: dict[str, DataFrame]
    samples: dict[str, DataFrame]


def smoke(
    spark: SparkSession,
    specs: Sequence[DatasetSpec],
    dataset_filter: str | None = None,
    root: str | None = None,
    sample_size: int = 5,
) -> SmokeReport:
    names = [s.name for s in specs]
    if dataset_filter is not None and dataset_filter not in names:
        raise ValueError(f"unknown dataset {dataset_filter!r}; available: {names}")
    rows, schemas, samples = [], {}, {}
    for spec in specs:
        if dataset_filter is not None and spec.name != dataset_filter:
            continue
        try:
            df = spec.run(spark, root)
            p = profile_table(df, spec.name, spec.target_column).first()
            schemas[spec.name] = schema_frame(spark, df, spec.target_column)
            samples[spec.name] = spark.createDataFrame(
                sample_rows(df, df.columns[:1], sample_size).collect(), df.schema
            )
            rows.append(
                (spec.name, spec.size_category, spec.path, p["rows"], p["columns"], spec.target_column,
                 p["target_nulls"], "ok", None)
            )
        except Exception as e:  # noqa: BLE001 - recorded, the next dataset still runs
            rows.append(
                (spec.name, spec.size_category, spec.path, None, None, spec.target_column, None, "error",
                 f"{type(e).__name__}: {e}")
            )
    return SmokeReport(spark.createDataFrame(rows, PROFILE_SCHEMA), schemas, samples)


def ok_profiles(report: SmokeReport) -> DataFrame:
    return report.profiles.where(F.col("status") == "ok")
