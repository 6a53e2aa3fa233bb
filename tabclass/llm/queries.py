"""The registered queries of this subpackage and their DuckDB SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabclass.llm.common import crc_bucket, table
from tabclass.llm.conversation_repair import audits, damage
from tabclass.llm.decontaminate import leaks
from tabclass.llm.fingerprints import fingerprints, near_classes
from tabclass.llm.html_text import extract_pages
from tabclass.llm.jaccard_join import jaccard_components
from tabclass.llm.language_id import predicted, train
from tabclass.llm.lexical_search import build_index, search
from tabclass.llm.line_dedup import line_dedup
from tabclass.llm.mix import mix
from tabclass.llm.pii import KINDS as PII_KINDS
from tabclass.llm.pii import find_pii, joined
from tabclass.llm.quality import scored
from tabclass.llm.quality import train as train_quality
from tabclass.llm.secret_scan import secret_scan
from tabclass.llm.toxicity import toxicity


def _held_out(n: int, remainder: int):
    return F.coalesce(crc_bucket(F.col("doc_id"), n) == remainder, F.lit(True))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fingerprints(docs, classes=near_classes(docs))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, ~_held_out(5, 0))
    verdict = docs.select("doc_id", _held_out(5, 0).alias("held_out"), predicted(model, F.col("text")).alias("v"))
    return verdict.select("doc_id", "held_out", F.col("v.lang").alias("lang_pred"), F.col("v.score").alias("score"), F.col("v.rejected").alias("rejected"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    count = lambda i: F.size(F.filter("known", lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{PII_KINDS[i]}") for i in range(4)], F.sha2(joined(F.col("known")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("known", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), extend=True)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_quality(docs, table(spark, sf_dir, "labels"), ~_held_out(4, 2))
    out = docs.select("doc_id", _held_out(4, 2).alias("held_out"), scored(model, F.col("text")).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents"))
    found = search(index, table(spark, sf_dir, "benchmark"))
    index.discard()
    return found


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = damage(table(spark, sf_dir, "conversations"))
    return audits(damaged, F.col("dropped")).drop("starts_system")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~_held_out(3, 1))
    return found.select(
        "doc_id", _held_out(3, 1).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
        F.array_join("evidence", ", ").alias("evidence"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_fingerprints": op2_fingerprints,
    "op3_language_id": op3_language_id,
    "op4_source_mix": op4_source_mix,
    "op5_pii": op5_pii,
    "op6_html_text": op6_html_text,
    "op7_line_dedup": op7_line_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_quality_knn": op9_quality_knn,
    "op10_decontaminate": op10_decontaminate,
    "op11_lexical_search": op11_lexical_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_toxicity": op13_toxicity,
}

#: Words with A-Z in lower case, as a list.
_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\x09-\\x0D]+')"

JACCARD_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
         range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
      WHERE 100 * p.c >= 75 * (x.n_shingles + y.n_shingles - p.c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS m FROM n UNION SELECT u.b, r.m FROM r JOIN u ON u.a = r.v AND r.m < u.b)
SELECT n.doc_id, n.n_shingles, min(r.m) AS component_id FROM n JOIN r ON r.v = n.doc_id GROUP BY ALL"""

#: A line goes if it lies in a run of 50 words or more that occurred earlier: every line of
#: such a run lies in a least window of it that starts, or one that ends, at a line with words.
LINES_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
           FROM documents WHERE text IS NOT NULL),
c AS (SELECT *, len(regexp_extract_all(line, '[^ \\x09-\\x0D]+')) AS n FROM l),
w AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM c),
win AS (SELECT a.doc_id, a.i AS first, min(b.i) AS last FROM w a JOIN w b ON a.doc_id = b.doc_id AND b.i >= a.i
        AND b.upto - a.upto + a.n >= 50 WHERE a.n > 0 GROUP BY ALL
        UNION SELECT b.doc_id, max(a.i) AS first, b.i AS last FROM w a JOIN w b ON a.doc_id = b.doc_id AND b.i >= a.i
        AND b.upto - a.upto + a.n >= 50 WHERE b.n > 0 GROUP BY ALL),
body AS (SELECT win.doc_id, win.first, win.last, string_agg(w.line, chr(10) ORDER BY w.i) AS body
         FROM win JOIN w ON w.doc_id = win.doc_id AND w.i BETWEEN win.first AND win.last GROUP BY ALL),
nth AS (SELECT doc_id, first, last, row_number() OVER (PARTITION BY body ORDER BY doc_id, first) AS k FROM body),
gone AS (SELECT DISTINCT w.doc_id, w.i FROM w JOIN nth ON nth.doc_id = w.doc_id AND w.i BETWEEN nth.first AND nth.last WHERE nth.k > 1),
cut AS (SELECT l.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (gone.i IS NULL), '') AS text,
               CAST(count(*) AS BIGINT) AS n_lines, CAST(count(gone.i) AS BIGINT) AS n_removed
        FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.i = l.i GROUP BY l.doc_id)
SELECT d.doc_id, cut.text, coalesce(cut.n_lines, 0) AS n_lines, coalesce(cut.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN cut ON cut.doc_id = d.doc_id"""

#: A term's maximal run, only A-Z lower-cased; the rest is the stated integer arithmetic.
_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

SEARCH_SQL = f"""
WITH t AS (SELECT doc_id, {_TERMS} AS t FROM documents),
n AS (SELECT doc_id, len(t) AS n FROM t WHERE len(t) > 0),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
f AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM t) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM f, c GROUP BY term),
q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT q.item_id, f.doc_id, CAST(sum(q.qtf * w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + (25 * n.n * c.docs) // c.terms)))) AS BIGINT) AS score
      FROM q JOIN f ON f.term = q.term JOIN w ON w.term = q.term JOIN n ON n.doc_id = f.doc_id, c GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20"""


def _repair_sql() -> str:
    """crc32 by bits; then a fold over a conversation's rows of the best (cost, audit,
    text) in each state, where a way is compared by its cost, written in nine
    digits, followed by its audit."""
    crc = (
        "xor(list_reduce(list_transform(range(1, octet_length(encode(key)) + 1), lambda i: CAST(('0x' || substr(hex(encode(key)), CAST(2 * i - 1 AS INTEGER), 2)) AS BIGINT)), "
        "lambda a, b: list_reduce(range(0, 8), lambda x, k: xor(x >> 1, (x & 1) * 3988292384), xor(a, b)), CAST(4294967295 AS BIGINT)), 4294967295)"
    )

    def way(state: str, cost: str, letter: str, text: str, first: bool = False) -> str:
        joined = f"{text}" if first else f"{state}.t || chr(10) || {text}"
        if text == "":
            joined = f"{state}.t"
        return (
            f"CASE WHEN {state} IS NULL THEN NULL ELSE {{'k': lpad(CAST(CAST({state}.k[:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {state}.k[10:] || '{letter}', 't': {joined}}} END"
        )

    def least(*ways: str) -> str:
        return f"list_min(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))"

    empty_user, empty_assistant = "'user:'", "'assistant:'"

    def closed(x: str) -> str:
        """Inserts after the states of ``x``: to u from any other state, then to a from u, then to u again."""
        u = least(f"{x}.u", way(f"{x}.q", "3", "I", empty_user, True), way(f"{x}.s", "3", "I", empty_user), way(f"{x}.a", "3", "I", empty_user))
        one = f"{{'q': {x}.q, 's': {x}.s, 'u': {u}, 'a': {x}.a}}"
        return one

    def to_a(x: str) -> str:
        return f"{{'q': {x}.q, 's': {x}.s, 'u': {x}.u, 'a': {least(f'{x}.a', way(f'{x}.u', '3', 'I', empty_assistant))}}}"

    keep = lambda state, initial, first=False: f"CASE WHEN r.fault NOT IN (1, 2) AND r.role[:1] = '{initial}' THEN {way(state, '(3 * CAST(r.fault = 3 AS INTEGER))', 'K', 'r.role || chr(58) || r.text', first)} END"
    rerole = lambda state, role, first=False: f"CASE WHEN r.fault NOT IN (1, 2) THEN {way(state, '(3 + 3 * CAST(r.fault = 3 AS INTEGER))', 'R', f'{chr(39)}{role}:{chr(39)} || r.text', first)} END"
    drop = lambda state: way(state, "4", "D", "")
    step = (
        f"{{'q': {drop('x.q')}, 's': {least(drop('x.s'), keep('x.q', 's', True))}, "
        f"'u': {least(drop('x.u'), keep('x.q', 'u', True), keep('x.s', 'u'), keep('x.a', 'u'), rerole('x.q', 'user', True), rerole('x.s', 'user'), rerole('x.a', 'user'))}, "
        f"'a': {least(drop('x.a'), keep('x.u', 'a'), rerole('x.u', 'assistant'))}}}"
    )
    # Lambdas have no local names: a one-element list names what a step made.
    chain = lambda start: f"list_transform(list_transform(list_transform([{start}], lambda y: {closed('y')}), lambda y: {to_a('y')}), lambda y: {closed('y')})[1]"
    none = "CAST(NULL AS STRUCT(k VARCHAR, t VARCHAR))"
    start = chain(f"{{'q': {{'k': '000000000', 't': ''}}, 's': {none}, 'u': {none}, 'a': {none}}}")
    state = "STRUCT(q STRUCT(k VARCHAR, t VARCHAR), s STRUCT(k VARCHAR, t VARCHAR), u STRUCT(k VARCHAR, t VARCHAR), a STRUCT(k VARCHAR, t VARCHAR))"
    return f"""
WITH RECURSIVE g AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
k AS (SELECT *, {crc} % 20 AS kind FROM g),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS again FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, again) AS nth,
             regexp_extract(text, '([^ \x09-\x0D])[ \x09-\x0D]*$', 1) AS last FROM d),
b AS (SELECT conv_id, i, turn, role, text, lag(role[:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before,
             CASE WHEN last = '' THEN 1 WHEN nth > 1 THEN 2 WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM o),
f AS (SELECT conv_id, 0 AS i, CAST({start} AS {state}) AS x FROM b WHERE i = 1
      UNION ALL
      SELECT f.conv_id, r.i, CAST(list_transform([f.x], lambda x: {chain(step)})[1] AS {state})
      FROM f JOIN b r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.i = f.i + 1),
e AS (SELECT conv_id, {least('x.q', 'x.a')} AS best FROM f QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
             count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
             count(*) FILTER (before IS NOT NULL AND before || role[:1] NOT IN ('su', 'ua', 'au')) AS illegal FROM b GROUP BY conv_id),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
       CAST(coalesce(best.k[:9], '0') AS BIGINT) AS cost, coalesce(best.k[10:], '') AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
FROM c LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""


ORACLE_SQL: dict[str, str] = {
    "op7_line_dedup": LINES_SQL,
    "op8_jaccard_join": JACCARD_SQL,
    "op11_lexical_search": SEARCH_SQL,
    "op12_conversation_repair": _repair_sql(),
}
