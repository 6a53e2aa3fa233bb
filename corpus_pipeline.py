"""A corpus through five operators: language ID, line dedup, n-gram Jaccard
join, benchmark decontamination, and mixing sources to target weights.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; all but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabclass.llm.common import crc_bucket, parted, saved, table
from tabclass.llm.decontaminate import leaks
from tabclass.llm.jaccard_join import jaccard_components
from tabclass.llm.language_id import predicted, train
from tabclass.llm.line_dedup import line_dedup
from tabclass.llm.mix import mix


def _row(docs: DataFrame) -> Column:
    """A row as one struct, so that its columns can't clash with a stage's."""
    return F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("row")


def _unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns])


def _key() -> Column:
    """Names a document: rows of the same id (or none) and text are the same one."""
    return F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("string"), F.col("text").isNull(), F.col("text"))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key isn't in ``keys(key)``; only rows that may be are moved."""
    rows = docs.select(_row(docs), _key().alias("key"))
    clear, rest = parted(rows, F.col("key"), keys)
    return _unpacked(clear.unionByName(rest.join(keys.distinct(), "key", "left_anti").select("row", "key")), docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model can tell.

    Null, empty and letterless texts go; rows with a null id stay, but are not learned
    from; repeated rows stay, each judged alike.  If nothing can be learned, all go.
    """
    model = train(docs, crc_bucket(F.col("doc_id"), 5) != 0)
    rows = docs.select(_row(docs), predicted(model, F.col("text")).alias("verdict"))
    return _unpacked(rows.where("NOT verdict.rejected"), docs.columns)


def without_repeated_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines cut to their ends; a text of which no word is
    left goes, one that had none before stays, as do null texts.

    Rows with the same id and text are one place and stay alike; a null id comes
    after all others.  ``n_chars`` is counted anew where something was cut.
    """
    rows = docs.select("doc_id", "text", _row(docs))
    cut = line_dedup(rows, extend=True)
    kept = cut.where(r"n_removed = 0 OR text RLIKE '[^\\x20\\x09-\\x0D]'")
    old = {c: F.col("row").getField(c) for c in docs.columns}
    new = old | {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(old["n_chars"])}
    return kept.select(*[new[c].alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id, null last, then
    the smallest key of id and text; of its repeated rows, the one of the smallest hash.

    Texts without words link with nothing, so they all stay, repeated ones too.
    """
    key = _key()
    found = saved(jaccard_components(docs.select(key.alias("doc_id"), "text")).where("n_shingles > 0"), "near-groups")
    members = found.groupBy(F.col("doc_id").alias("key"), "component_id").agg(F.count("*").alias("rows"))
    several = members.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    near = saved(members.join(several, "component_id").select("component_id", "key"), "near-members")
    ids = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("id")).join(near, "key", "left_semi").distinct()
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    first = near.join(ids, "key").groupBy("component_id").agg(F.min(place)["key"].alias("first"))
    dropped = saved(near.join(first, "component_id").where("key <> first").select("key"), "near-duplicates")
    kept = _without(docs, dropped)
    # Repeated rows of one document: chosen map-side, so copies never meet in a task.
    again = saved(members.where("rows > 1").select("key"), "near-repeated")
    rows = kept.select(_row(kept), _key().alias("key"))
    once, rest = parted(rows, F.col("key"), again)
    rest = rest.join(again.withColumn("more", F.lit(True)), "key", "left")
    single = rest.where("more IS NULL").select("row")
    chosen = rest.where("more").groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return _unpacked(once.select("row").unionByName(single).unionByName(chosen), docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage.

    Every row that holds one goes, also with a null or repeated id; another row of the
    same id with another text is judged by its own text.  Null texts hold none.
    """
    found = leaks(docs.select(_key().alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _without(docs, saved(found.select(F.col("doc_id").alias("key")).distinct(), "leaking"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each kept document is taken for the target mix of sources: one row a
    row, null sources last, null texts of size 0."""
    return mix(docs)


STAGES = [
    ("language ID", known_language),
    ("line dedup", without_repeated_runs),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_leaks),
    ("mixing sources", mixed),
]

#: A trained model decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
