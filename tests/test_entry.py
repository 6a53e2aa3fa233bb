import __spark_entry__ as E

from conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "prediction", "n"] and sum(r.n for r in rows) > 0


def test_every_oracle_has_a_query():
    qs, oracles = E.queries(), E.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(qs) >= 50


def test_some_queries_at_smallest_scale(spark):
    qs = E.queries()
    for key in ("recipe_salary", "hash_split", "stratified_split", "profile_table", "scan_csv"):
        assert qs[key](spark, SF001).count() > 0
