"""Train / test splits.

* ``random_split``: the reference's ``randomSplit(seed=42)``.  Its result
  depends on how the rows are partitioned (1, 4 and 8 partitions give three
  different splits) and Spark sorts every partition on all columns before
  sampling, so it is kept for parity only.
* ``hash_split``: a row goes to train when the first 32 bits of md5(key),
  a number below 2**32, fall below ``ratio * 2**32``.  It is a narrow per-row
  expression: no shuffle, no sort, the same rows at any partitioning or
  cluster size, and it re-computes identically after an executor is lost.
* ``stratified_split``: exactly ``round(ratio * n_c)`` rows of each class go to
  train, the ones with the smallest (hash, key).  Done without a window over
  whole classes (one task per class would have to sort a third of the data
  when one class holds a third of the rows): the hash is uniform, so rows are
  counted per (class, hash bucket) with a map-side-combined aggregate; the
  small count table finds, per class, the one bucket that holds the boundary
  (and, when that bucket is still large, a second count pass over the full
  32-bit hash narrows it to one hash value); the distinct (hash, key) pairs of
  that range, counted map-side, give the exact threshold; and the final flag
  is a per-row comparison with the threshold of the row's class, brought in
  by a join with a table of one row per class.  No
  task ever sorts more than a bounded number of distinct keys, and a key
  repeated a billion times is one counted pair.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabclass.sources.leases import leased_table

DEFAULT_SEED = 42
DEFAULT_TRAIN_RATIO = 0.8
SPLIT_COL = "split"
HASH_RANGE = 1 << 32
BUCKET_BITS = 16
BROADCAST_STRATA = 10_000
# Distinct (hash, key) pairs one task may rank per class before a second level is used.
RANK_LIMIT = 1_000_000


def _check_ratio(ratio: float) -> None:
    if not 0.0 < ratio < 1.0:
        raise ValueError(f"the train share must lie between 0 and 1, not {ratio}")


def random_split(
    df: DataFrame, ratio: float = DEFAULT_TRAIN_RATIO, seed: int = DEFAULT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's own sampler; the sides change with the partitioning."""
    _check_ratio(ratio)
    return tuple(df.randomSplit([ratio, 1.0 - ratio], seed))


def key_text(keys: Sequence[str]) -> Column:
    """Text of the row key.  Several columns are joined with '|', NULL written
    as ``\\N`` so that (a, NULL, b) and (a, b, NULL) differ.  With no key at all
    (datasets without an id), pass every column: the whole row is the key, and
    identical rows simply land on the same side."""
    if not keys:
        raise ValueError("need at least one key column")
    if len(keys) == 1:
        return F.coalesce(F.col(keys[0]).cast("string"), F.lit("\\N"))
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys])


def key_hash32(keys: Sequence[str]) -> Column:
    """First 8 hex digits of md5(key text) as a number in [0, 2^32)."""
    return F.conv(F.substring(F.md5(key_text(keys)), 1, 8), 16, 10).cast("bigint")


def hash_split_flag(keys: Sequence[str], ratio: float = DEFAULT_TRAIN_RATIO) -> Column:
    _check_ratio(ratio)
    return F.when(key_hash32(keys) < F.lit(round(ratio * HASH_RANGE)), F.lit("train")).otherwise(F.lit("test"))


def hash_split(
    df: DataFrame, keys: Sequence[str] | str, ratio: float = DEFAULT_TRAIN_RATIO, column: str = SPLIT_COL
) -> DataFrame:
    """Add a ``split`` column ('train' / 'test') from a hash of the row key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.withColumn(column, hash_split_flag(keys, ratio))


def _boundaries(counts: DataFrame) -> DataFrame:
    """Per class, the bucket holding the wanted rank.

    ``counts`` has (_s class, _b bucket, _n rows, _t wanted rank in the class);
    the window runs over the small count table (at most 65536 buckets per
    class).  Returns (_s, _b, _r rank inside the bucket, _n), a row per class.
    """
    w = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = counts.withColumn("_cum", F.sum("_n").over(w))
    hit = c.where((F.col("_cum") - F.col("_n") < F.col("_t")) & (F.col("_t") <= F.col("_cum")))
    return hit.select("_s", "_b", (F.col("_t") - (F.col("_cum") - F.col("_n"))).alias("_r"), "_n")


def stratified_split(
    df: DataFrame,
    keys: Sequence[str] | str,
    stratum: str,
    ratio: float = DEFAULT_TRAIN_RATIO,
    column: str = SPLIT_COL,
) -> DataFrame:
    """Exact per-class ratio; see the module docstring for the plan.

    Rows with the same key hash and key tie; a tie group is never split, so
    with duplicate keys a class can get a few more train rows than
    ``round(ratio * n_c)``.  With unique keys the count is exact.
    """
    _check_ratio(ratio)
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_key = key_text(keys) if len(keys) > 1 else F.col(keys[0])
    base = df.withColumn("_h", key_hash32(keys)).withColumn("_o", order_key).withColumn("_cs", F.col(stratum))

    # Level 1: rows per (class, top 16 hash bits); partial aggregation, only
    # the counts shuffle.  The wanted rank per class is round(ratio * n_c).
    counts = (
        base.groupBy(F.col("_cs").alias("_s"), F.shiftright("_h", 32 - BUCKET_BITS).alias("_b"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_t", F.round(F.sum("_n").over(Window.partitionBy("_s")) * F.lit(float(ratio))).cast("bigint"))
    )
    level1 = _boundaries(counts).persist()
    biggest, strata = level1.agg(F.max("_n"), F.count(F.lit(1))).first()
    # Tables of a row per class: broadcast behind this check, else joined as Spark sees fit.
    small = F.broadcast if strata <= BROADCAST_STRATA else lambda table: table
    # Hash range [lo, hi] and rank r to look for, per class.
    low = F.shiftleft("_b", BUCKET_BITS)
    ranges = level1.select("_s", low.alias("_lo"), low.bitwiseOR(F.lit(0xFFFF)).alias("_hi"), "_r")

    # Level 2 (only for very large classes): rows per exact 32-bit hash inside
    # the boundary bucket.
    if biggest is not None and biggest > RANK_LIMIT:
        wanted = ranges.select("_s", "_lo", F.col("_r").alias("_t"))
        cand = base.join(
            wanted, F.col("_cs").eqNullSafe(F.col("_s")) & (F.col("_h").bitwiseAND(F.lit(~0xFFFF)) == F.col("_lo"))
        )
        counts2 = cand.groupBy("_s", F.col("_h").alias("_b"), "_t").agg(F.count(F.lit(1)).alias("_n"))
        ranges = _boundaries(counts2).select("_s", F.col("_b").alias("_lo"), F.col("_b").alias("_hi"), "_r")

    # Threshold (hash, key) per class: distinct (hash, key) pairs with their
    # counts inside the range (duplicates collapse map-side), then the first
    # pair whose running count reaches the rank.
    pairs = (
        base.join(small(ranges), F.col("_cs").eqNullSafe(F.col("_s")) & F.col("_h").between(F.col("_lo"), F.col("_hi")))
        .groupBy("_s", "_h", "_o", "_r")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    w = Window.partitionBy("_s").orderBy("_h", "_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    th = (
        pairs.withColumn("_cum", F.sum("_n").over(w))
        .where((F.col("_cum") - F.col("_n") < F.col("_r")) & (F.col("_r") <= F.col("_cum")))
        .select("_s", F.col("_h").alias("_th"), F.col("_o").alias("_to"))
    )
    # Written and reread, so that the flag below is one scan and one join; the
    # result holds its lease.
    th = leased_table(th, "strata")

    # Per-row flag: (hash, key) <= the class threshold.  Classes with k = 0
    # have no threshold and go wholly to test.
    flagged = base.join(small(th), F.col("_cs").eqNullSafe(F.col("_s")), "left")
    # NULL keys sort first among equal hashes (the window's ascending order).
    tie_ok = (F.col("_o") <= F.col("_to")) | F.col("_o").isNull()
    in_train = (F.col("_h") < F.col("_th")) | ((F.col("_h") == F.col("_th")) & tie_ok)
    out = flagged.withColumn(
        column, F.when(F.coalesce(in_train, F.lit(False)), F.lit("train")).otherwise(F.lit("test"))
    ).drop("_h", "_o", "_cs", "_s", "_th", "_to")
    out._lease = th._lease
    return out


def split_frames(df: DataFrame, column: str = SPLIT_COL) -> tuple[DataFrame, DataFrame]:
    """One flagged frame -> (train, test), both without the flag column."""
    return (
        df.where(F.col(column) == "train").drop(column),
        df.where(F.col(column) == "test").drop(column),
    )


def train_test_split(
    df: DataFrame,
    ratio: float = DEFAULT_TRAIN_RATIO,
    seed: int = DEFAULT_SEED,
    method: str = "random",
    keys: Sequence[str] | str | None = None,
    stratum: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by ``random`` (reference), ``hash`` or ``stratified``."""
    if method == "random":
        return random_split(df, ratio, seed)
    if keys is None:
        raise ValueError(f"{method} split needs key columns")
    if method == "hash":
        return split_frames(hash_split(df, keys, ratio))
    if method == "stratified":
        if stratum is None:
            raise ValueError("stratified split needs a stratum column")
        return split_frames(stratified_split(df, keys, stratum, ratio))
    raise ValueError(f"unknown split method {method!r}")
