"""A subset of the driver's check inside pytest: Spark query vs DuckDB SQL at sf0.001."""
import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF001

KEYS = [
    "recipe_social", "recipe_fraud", "recipe_matches", "recipe_salary", "cast_long", "haversine_km",
    "tercile_target", "one_hot", "build_features", "hash_split", "stratified_split",
    "predict_naive_bayes", "train_naive_bayes", "eval_weighted_f1", "schema_report", "infer_column_roles",
]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF001)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    o_names = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_names)
    assert _multiset(df.columns, s_rows) == _multiset(o_names, o_rows)
