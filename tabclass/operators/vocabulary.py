"""Category vocabularies of any size: ranked and joined inside Spark.

``StringIndexer`` and ``fit_vocabularies`` bring every category to the driver, which
is right for one-hot features of moderate width.  Here nothing but a row a column
does: categories are counted with map-side combine, put in order (count descending,
then value) by a range partitioning, and numbered by the rows of the partitions
before.  The vocabulary is a table, and rows get their index by a join:

* a vocabulary of up to BROADCAST_VALUES categories is broadcast;
* of a larger one, the values that hold 1 / HEAVY of the rows each, HEAVY at most, are
  broadcast, and the rest, of which none is frequent, is joined by a shuffle.  Rows
  that need nothing from that join are spread by a salt, so neither a frequent value
  nor NULL fills one task.

Indexes are doubles with nominal metadata, as those of MLlib's indexer with
``handleInvalid="keep"``: a NULL or unseen value gets the number of categories.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabclass.sources.leases import leased_table, release

BROADCAST_VALUES = 100_000
HEAVY = 1000
SALTS = 4096
_ROW_BITS = 33  # of monotonically_increasing_id


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for every non-null value of every column, one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]))
    return (
        df.select(pairs.alias("p")).select("p.column", "p.value").where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def dense_rank_table(counts: DataFrame, name: str = "vocabulary") -> DataFrame:
    """``counts(column, value, n)`` with ``idx``: 0, 1, ... by count descending, then
    value, for each column.  No task sees more than a range of the table."""
    counts = leased_table(counts, f"{name}-counts")  # the range partitioning reads it twice
    order = ["column", F.col("n").desc(), "value"]
    ranged = counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = leased_table(ranged, f"{name}-order")
    release(counts)
    part, nth = F.shiftright("_at", _ROW_BITS), F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ranged_ = ranged.withColumn("_part", part).withColumn("_nth", nth)
    # A range of the order is in one partition: partitions + columns rows at most.
    starts = ranged_.groupBy("column", "_part").agg(F.min("_nth").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("column", "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    ranked = ranged_.join(F.broadcast(starts), ["column", "_part"]).select("column", "value", "n", (F.col("_nth") + F.col("_shift")).alias("idx"))
    out = leased_table(ranked, name)
    release(ranged)
    return out


def fit_vocabulary_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The vocabulary (column, value, n, idx) of ``columns``; ``release`` deletes it."""
    return dense_rank_table(value_counts(df, columns))


def index_columns(df: DataFrame, vocabulary: DataFrame, columns: Sequence[str], suffix: str = "_idx") -> DataFrame:
    """``df`` with the index of each column's value, ``<column><suffix>``."""
    known = {r["column"]: r for r in vocabulary.groupBy("column").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("rows")).collect()}
    for i, c in enumerate(columns):
        size, rows = (known[c]["size"], known[c]["rows"]) if c in known else (0, 0)
        value, index = f"_value{i}", f"_index{i}"
        own = vocabulary.where(F.col("column") == c)
        side = lambda d, name: d.select(F.col("value").alias(value), F.col("idx").alias(name))
        df = df.withColumn(value, F.col(f"`{c}`").cast("string"))
        if size <= BROADCAST_VALUES:
            df = df.join(F.broadcast(side(own, index)), value, "left")
        else:
            heavy = F.col("n") * HEAVY >= rows
            df = df.join(F.broadcast(side(own.where(heavy), f"{index}h")), value, "left")
            rare = F.col(value).isNotNull() & F.col(f"{index}h").isNull()
            df = df.withColumn("_salt", F.when(rare, F.lit(-1)).otherwise(F.monotonically_increasing_id() % SALTS))
            df = df.withColumn(value, F.when(rare, F.col(value)))
            df = df.join(side(own.where(~heavy), f"{index}r").withColumn("_salt", F.lit(-1)), [value, "_salt"], "left").drop("_salt")
            df = df.withColumn(index, F.coalesce(f"{index}h", f"{index}r")).drop(f"{index}h", f"{index}r")
        out = f"{c}{suffix}"
        meta = {"ml_attr": {"type": "nominal", "num_vals": size + 1, "name": out}}
        df = df.withColumn(out, F.coalesce(F.col(index), F.lit(size)).cast("double").alias(out, metadata=meta)).drop(value, index)
    return df
