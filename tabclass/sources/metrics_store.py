"""Metrics rows: schema, append-per-experiment sink, and reading runs back."""
from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from tabclass.sources.leases import file_system

# Fixed values that must equal the reference: metrics row fields, in order.
METRICS_FIELDS = (
    "dataset", "classifier", "workers", "partitions",
    "accuracy", "f1", "train_time_s", "predict_time_s", "total_time_s",
)
METRICS_SCHEMA = (
    "dataset string, classifier string, workers int, partitions int, accuracy double, "
    "f1 double, train_time_s double, predict_time_s double, total_time_s double, "
    "status string, error string"
)


def metrics_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    cols = [f.strip().split(" ")[0] for f in METRICS_SCHEMA.split(",")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], METRICS_SCHEMA)


class MetricsSink:
    """One folder of rows per finished experiment, published by one rename, so a crash
    keeps the rest and readers never see half a row.

    A row is written aside, below ``_aside``, which readers skip, and then moved to
    ``pair-<key>``, the key being that of its (dataset, classifier, workers,
    partitions).  A pair whose folder is there is finished: ``finished`` lists the
    rows that succeeded, and a run started with ``resume`` leaves those pairs out.  A
    failed pair's row is replaced when the pair runs again.

    ``path`` should be on shared storage (the cluster's checkpoint folder or
    a table location), never a machine-local folder.
    """

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        if fmt not in ("parquet", "csv"):
            raise ValueError(f"metrics sink format must be parquet or csv, got {fmt!r}")
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt

    def start(self, resume: bool = False) -> None:
        """Begin a run: rows of an earlier run of this folder go, unless it is resumed."""
        if resume:
            fs, aside = file_system(self.spark, f"{self.path}/_aside")
            fs.delete(aside, True)
            if fs.exists(aside.getParent()):
                return
        metrics_frame(self.spark, []).write.mode("overwrite").option("header", "true").format(self.fmt).save(self.path)

    def append(self, row: dict) -> None:
        aside = f"{self.path}/_aside/{uuid.uuid4().hex}"
        df = metrics_frame(self.spark, [row]).coalesce(1)
        df.write.option("header", "true").format(self.fmt).save(aside)
        fs, place = file_system(self.spark, f"{self.path}/pair-{pair_key(row)}")
        fs.delete(place, True)  # an earlier try of this pair
        if not fs.rename(file_system(self.spark, aside)[1], place):
            raise OSError(f"{aside} can't be published as {place.toString()}")

    def finished(self) -> list[dict]:
        """The rows of the pairs that succeeded: one for each pair of the grid."""
        fs, at = file_system(self.spark, self.path)
        if not fs.exists(at):
            return []
        return [r.asDict() for r in self.read().where("status = 'ok'").collect()]

    def read(self) -> DataFrame:
        return read_metrics(self.spark, self.path, self.fmt)


def pair_key(row: dict) -> str:
    """A pair's folder name: the same for the same pair in every run."""
    named = json.dumps([row.get(c) for c in ("dataset", "classifier", "workers", "partitions")])
    return hashlib.sha256(named.encode()).hexdigest()[:24]


def run_folder(base: str, workers: int, partitions: int) -> str:
    """Folder of one run, named as the reference names its CSVs: experiments_w{W}_p{P}."""
    return f"{base.rstrip('/')}/experiments_w{workers}_p{partitions}"


def read_metrics(spark: SparkSession, paths: str | list[str], fmt: str = "parquet") -> DataFrame:
    """All metrics rows from one or many run folders (globs allowed), unioned.

    Each file carries its own header, so CSV runs combine without the shell's
    'first header, then bodies' step.
    """
    reader = spark.read.schema(METRICS_SCHEMA).option("recursiveFileLookup", "true")
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.format(fmt).load(paths if isinstance(paths, list) else [paths])
