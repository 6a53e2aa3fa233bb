"""The pipeline's stages on repeated rows, null ids and texts, clashing columns, empty tables."""
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

from test_operators import prose

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("_verdict", "verdict", "n_removed", "n_lines", "key", "row", "component_id", "rows", "more")
PASSAGE = prose(99, 60)


def frame(spark, rows):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], FIELDS)
    for c in CLASH:
        df = df.withColumn(c, F.lit("mine"))
    return df


@pytest.fixture()
def sf(spark, tmp_dir):
    spark.createDataFrame([(1, PASSAGE), (2, None)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    return tmp_dir


def run(spark, stage, rows, sf):
    docs = frame(spark, rows)
    out = stage(spark, docs, sf)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    found = out.collect()
    assert all(r[c] == "mine" for r in found for c in CLASH)
    return Counter((r.doc_id, r.text) for r in found), found


def test_one_document_of_each_group_stays(spark, sf):
    a, b, c = prose(1, 80), prose(2, 80), prose(3, 80)
    near = a + " more words"
    rows = [(5, a), (5, a), (7, near), (None, a), (None, c), (None, c), (3, b), (3, prose(4, 80)), (9, b + " end"), (8, ""), (8, ""), (6, None)]
    got, _ = run(spark, P.one_of_each_group, rows, sf)
    assert got == Counter([(5, a), (None, c), (3, b), (3, prose(4, 80)), (8, ""), (8, ""), (6, None)])


def test_no_leaking_row_stays(spark, sf):
    leak, clean = prose(5, 30) + " " + PASSAGE + " " + prose(6, 30), prose(7, 90)
    got, _ = run(spark, P.without_leaks, [(None, leak), (None, clean), (1, leak), (1, clean), (1, clean), (2, None), (3, "")], sf)
    assert got == Counter([(None, clean), (1, clean), (1, clean), (2, None), (3, "")])


def test_repeated_runs_are_cut_and_columns_kept(spark, sf):
    run_ = "\n".join(prose(s, 12) for s in range(20, 26))
    own = [prose(s, 12) for s in (30, 31, 32)]
    rows = [(1, f"{own[0]}\n{run_}"), (2, f"{own[1]}\n{run_}\n{own[2]}"), (None, run_), (4, ""), (5, None), (6, " ")]
    got, found = run(spark, P.without_repeated_runs, rows, sf)
    assert got == Counter([(1, f"{own[0]}\n{run_}"), (2, f"{own[1]}\n{own[2]}"), (4, ""), (5, None), (6, " ")])
    assert all(r.n_chars == len(r.text or "") for r in found)


def test_unknown_languages_go(spark, sf):
    rows = [(i, prose(i, 40)) for i in range(40)] + [(None, prose(50, 40)), (41, None), (42, "1 2 3"), (3, prose(3, 40))]
    got, _ = run(spark, P.known_language, rows, sf)
    assert got[(3, prose(3, 40))] == 2 and (41, None) not in got and (42, "1 2 3") not in got and sum(got.values()) >= 40


@pytest.mark.parametrize("stage", [s for _, s in P.STAGES[:-1]])
def test_stages_take_empty_tables(spark, sf, stage):
    assert run(spark, stage, [], sf)[0] == Counter()
