"""Partitioning and persistence helpers."""
from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabclass.sources.leases import leased_checkpoint, leased_table

#: Rows that a partition of a spread table has at least, and at most.
LEAST_ROWS, MOST_ROWS = 5_000, 500_000


def repartition_rows(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """``repartition(n)`` (round robin) or by keys, into one partition or more."""
    if partitions < 1:
        raise ValueError(f"can't spread rows over {partitions} partitions")
    return df.repartition(partitions, *keys) if keys else df.repartition(partitions)


def balance_partitions(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread an input that arrives in too few partitions (one unsplittable
    file, a single Parquet row group, a multi-line CSV) over the cluster.

    Only when the scan yields fewer partitions than ``min_partitions``
    (default: the cluster's default parallelism) is a round-robin
    repartition added; a large, well-split input is returned untouched, so on
    a real cluster this costs nothing.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. Spark Connect): leave the plan alone
        return df
    if current >= target:
        return df
    return df.repartition(target)


def spread_rows(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows evenly, if a few partitions hold most of them, so that steps that
    walk all rows many times (fits) use the whole cluster.

    A compressed table of some MB comes as one or two row groups, however many rows
    and cores there are.  Counted are rows, not partitions, since a scan may have
    empty ones.  ``partitions`` (default: the cluster's default parallelism) is the
    least number; none holds more than MOST_ROWS.  Small tables (LEAST_ROWS a
    partition) and even ones are returned untouched.  Rows go to the same partitions
    in the same order each time, which what samples by partition depends on.
    """
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("at")).count().collect()]
    rows = sum(counts)
    target = partitions or df.sparkSession.sparkContext.defaultParallelism
    n = max(min(target, rows // LEAST_ROWS), -(-rows // MOST_ROWS))
    if n <= 1 or max(counts) * n <= 2 * rows:
        return df
    return df.repartition(n).sortWithinPartitions(*[F.col(f"`{c}`") for c in df.columns])


def set_shuffle_partitions(spark: SparkSession, partitions: int) -> None:
    if partitions < 1:
        raise ValueError(f"a shuffle needs one partition or more, not {partitions}")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, fill: bool = True):
    """Persist for the block, fill the cache first (so timings exclude it), release after.

    Cached blocks lost with an executor are recomputed from lineage, so this
    survives executor loss; use ``materialize`` when the lineage is expensive.
    """
    df.persist(level)
    try:
        if fill:
            df.count()
        yield df
    finally:
        df.unpersist()


def materialize(df: DataFrame, how: str = "persist", eager: bool = True) -> DataFrame:
    """Fill a reusable copy of ``df``.

    * ``persist``: memory + disk blocks; lost blocks are recomputed from lineage.
      With ``eager=False`` the blocks are filled by the next job that scans
      the rows (saves a pass when that job reads every row anyway).
    * ``checkpoint``: reliable checkpoint into the shared ``spark.checkpoint.dir``
      (lineage cut; never a local checkpoint).
    * ``parquet``: a Parquet table in a fresh folder under the same shared
      checkpoint folder, read back; later reads get column pruning and filter
      pushdown, and the lineage is cut.

    ``release`` frees the copy; durable ones hold a lease until then.
    """
    if how == "persist":
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        if eager:
            out.count()
        return out
    if how == "checkpoint":
        return leased_checkpoint(df)
    if how == "parquet":
        return leased_table(df, "table")
    raise ValueError(f"unknown materialisation {how!r}")
