"""Small helpers that the operators share."""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabclass.session import scratch_path

#: Bits of the fixed-size membership filter (2 MB, whatever the data's size).
FILTER_BITS = 24
#: Rows of an Arrow batch at most.  JVM and Python each hold a batch of whole
#: texts for every task, so this bounds their memory; it changes no result.
BATCH_ROWS = 1000

#: Share of its largest heap that the driver may hold before garbage is collected.
HEAP_SHARE = 0.5

_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Arrow batches of ``rows`` at most; the session's own setting comes back."""
    before = spark.conf.get(_BATCH_KEY)
    if not 0 < int(before) <= rows:
        spark.conf.set(_BATCH_KEY, rows)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_KEY, before)


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The jobs' shuffle files go as soon as the job is done: what it wrote cuts the lineage."""
    before = spark.conf.get(_CLEANUP_KEY, "false")
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP_KEY, before)


def collect_garbage(spark: SparkSession) -> bool:
    """Have the driver drop what the jobs so far left behind (plans, task binaries,
    broadcast blocks), if its heap has grown past HEAP_SHARE of what it may take.

    A job of many tasks leaves much garbage and little else; left alone, the heap
    grows to its limit before any of it goes.  Changes no result.
    """
    heap = spark.sparkContext._jvm.Runtime.getRuntime()
    full = heap.totalMemory() > HEAP_SHARE * heap.maxMemory()
    if full:
        spark.sparkContext._jvm.System.gc()
    return full


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's shared checkpoint folder and reread it:
    lineage is cut, a lost executor costs no recomputation, and the shuffle files
    of the job are removed at its end."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with small_batches(spark), _shuffles_dropped(spark):
        df.write.parquet(path)
    collect_garbage(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``saved`` wrote, once nothing reads them any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def pick(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that other
    columns of the input can't clash with the operator's.

    ``pick(docs, doc_id="id", text="body")`` has columns ``doc_id, text``.
    """
    return docs.select(*[docs[f"`{source}`"].alias(name) for name, source in columns.items()])


def crc_bucket(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as remainder null."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(n))


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """A fixed-size bitmap of the top bits of the one column (64-bit hashes).
    It only saves moving rows that a later exact join would drop."""
    at = f"shiftrightunsigned(`{hashes.columns[0]}`, {64 - FILTER_BITS})"
    words = (
        hashes.selectExpr(f"{at} >> 5 AS word", f"shiftleft(1L, cast({at} & 31 AS int)) AS bit")
        .where("word IS NOT NULL").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    )
    out = np.zeros(1 << (FILTER_BITS - 5), dtype=np.uint32)
    found = words.toArrow()
    if found.num_rows:
        out[found["word"].to_numpy().astype(np.int64)] = found["bits"].to_numpy().astype(np.uint32)
    del found
    pa.default_memory_pool().release_unused()
    return out


def in_filter(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
    return (bitmap[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1


def maybe_in(bitmap: np.ndarray, id_col: Column) -> Column:
    """True for every id whose xxhash64 is in the bitmap, and for few others;
    only the ids go to Python."""

    @F.pandas_udf("boolean")
    def hit(hashed: pd.Series) -> pd.Series:
        return pd.Series(in_filter(bitmap, hashed.to_numpy()))

    return hit(F.xxhash64(id_col))


def parted(docs: DataFrame, key: Column, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` as (rows whose key is surely not in the one column of ``ids``,
    all others), so that a join of whole texts moves only the others."""
    bitmap = hash_filter(ids.select(F.xxhash64(ids.columns[0])))
    hit = maybe_in(bitmap, key)
    return docs.where(~hit), docs.where(hit)


def without(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id isn't in the one column of ``ids``; null ids stay."""
    clear, rest = parted(docs, F.col(f"`{id_col}`"), ids)
    return clear.unionByName(rest.join(ids.withColumnRenamed(ids.columns[0], id_col).distinct(), id_col, "left_anti").select(*docs.columns))
