"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a share of a word budget by weight, but no more than twice
its own size; what it can't take is shared again among the others.  A source
first repeats all its documents as often as the target allows (0, 1 or 2
times).  The rest of its budget is filled with one more copy of some documents,
planned on the counts of documents by exact length: each length gives its
proportional part, and a bounded-knapsack table fits what then remains as
closely as lengths allow.  Which documents of a length are taken is decided by
a seeded hash, so reruns agree.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabclass.llm.common import pick, saved

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
SEED = 20240601
#: Words that the knapsack table spans; what exceeds it is filled longest first.
TABLE = 1 << 16
#: Hash ranges in which a length's documents are counted before any is ranked.
RANGES = 4096

WORD = r"[^\x20\x09-\x0D]+"


def fill(budget: int, size: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How many documents of each size to take so that their words come as close
    below ``budget`` as a bounded knapsack over the remainder can bring them."""
    take = np.zeros(len(size), dtype=np.int64)
    total = int((size * count).sum())
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return np.where(size > 0, count, 0)
    take = np.array([int(c) * budget // total if s > 0 else 0 for s, c in zip(size.tolist(), count.tolist())], dtype=np.int64)
    rest = budget - int((take * size).sum())
    order = [i for i in np.argsort(-size, kind="stable") if size[i] > 0]
    for i in order:
        if rest <= TABLE:
            break
        more = min(int(count[i] - take[i]), (rest - TABLE) // int(size[i]) + 1, rest // int(size[i]))
        take[i] += more
        rest -= more * int(size[i])
    rest = min(rest, total)
    # Items are binary parts of each length's remaining documents; each sum
    # remembers the item by which it was first reached.
    reached = np.zeros(rest + 1, dtype=bool)
    reached[0] = True
    via = np.full(rest + 1, -1, dtype=np.int32)
    items: list[tuple[int, int]] = []
    for i in order:
        left, part = int(count[i] - take[i]), 1
        while left > 0 and not reached[rest]:
            k = min(part, left)
            left, part = left - k, part * 2
            step = k * int(size[i])
            if step > rest:
                break
            new = reached[: rest + 1 - step] & ~reached[step:]
            via[step:][new] = len(items)
            reached[step:] |= new
            items.append((i, k))
        if reached[rest]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at > 0:
        i, k = items[via[at]]
        take[i] += k
        at -= k * int(size[i])
    return take


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    """Copies of every document, and how many documents of a size get one more."""
    total, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    copies = min(int(target // total), MOST_COPIES) if total else 0
    budget = int(round(target - copies * total))
    size, count = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
    extra = fill(budget, size, count) if copies < MOST_COPIES else np.zeros(len(size), np.int64)
    return pd.DataFrame(
        {"rank": group["rank"].to_numpy(), "size": size, "source_size": total, "target": target, "copies": copies, "extra": extra}
    )


def targets(sources: DataFrame) -> DataFrame:
    """``sources(source, source_size)`` with ``rank`` and ``target``: shares by
    weight up to the cap, found in closed form (after sorting by cap per weight
    the capped sources are a prefix).  One row per source goes through one task."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    one = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(one)).withColumn("w", weight).withColumn("cap", F.col("source_size") * float(MOST_COPIES))
    every = Window.partitionBy(F.lit(1))
    upto = every.orderBy(F.col("cap") / F.col("w"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        ranked.withColumn("budget", F.sum("source_size").over(every) * SHARE)
        .withColumn("before_cap", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
        .withColumn("left_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
    )
    level = (F.col("budget") - F.col("before_cap")) / F.col("left_w")  # share of one unit of weight if all before are capped
    ranked = ranked.withColumn("level", F.when(level * F.col("w") <= F.col("cap"), level))
    ranked = ranked.withColumn("level", F.max("level").over(every))  # the first that isn't capped has the highest level
    return ranked.select("source", "rank", "source_size", F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("w")), F.col("cap")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs``.

    Null and empty texts have size 0 and take 0 words.  Rows without a source
    form a source of their own, the last.  Rows that repeat an id are documents
    of their own; among equal ones it doesn't matter which is taken.  Other
    columns are ignored; an empty table gives an empty result.
    """
    rows = pick(docs, doc_id=id_col, text=text_col, source=source_col)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = rows.select("doc_id", "source", size.alias("size"), F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)).alias("h"))
    rows = saved(rows.withColumn("range", F.pmod("h", F.lit(RANGES)).cast("int")), "mix-sizes")

    lengths = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    sources = saved(targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))), "mix-targets")
    same = F.col("l.source").eqNullSafe(F.col("s.source"))
    planned = lengths.alias("l").join(sources.alias("s"), same).select("s.rank", "l.size", "l.n", "s.source_size", "s.target")
    plan = planned.groupBy("rank").applyInPandas(_plan, "rank int, size long, source_size long, target double, copies long, extra long")

    # How many documents of the same length come in earlier hash ranges.
    counted = rows.groupBy("source", "size", "range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    named = plan.join(sources.select("rank", "source"), "rank")
    cut = counted.alias("c").join(named.alias("p"), F.col("c.source").eqNullSafe(F.col("p.source")) & (F.col("c.size") == F.col("p.size")))
    cut = cut.select("c.source", "c.size", "c.range", "c.before", "p.source_size", "p.target", "p.copies", "p.extra")
    within = Window.partitionBy("source", "size", "range").orderBy("h", "doc_id")
    ranked = rows.withColumn("k", F.row_number().over(within))
    on = F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.size") == F.col("c.size")) & (F.col("r.range") == F.col("c.range"))
    out = ranked.alias("r").join(cut.alias("c"), on)
    copies = F.col("c.copies") + F.when(F.col("c.before") + F.col("r.k") <= F.col("c.extra"), 1).otherwise(0)
    return out.select("r.doc_id", "r.size", "c.source_size", "c.target", (F.col("r.size") * copies).cast("long").alias("taken"))
