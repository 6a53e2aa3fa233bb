"""

``queries()`` maps each operator key to a Spark query over the driver tables
(tabclass/plans/queries.py); ``oracle_sql()`` gives the same result in DuckDB
"""
from __future__ import annotations

import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: exact-tercile salary recipe on ``part`` -> features -> hash
    split -> Gaussian naive Bayes -> confusion matrix (label, prediction, n)."""
    from tabclass.plans.queries import q_confusion_matrix
    from tabclass.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return q_confusion_matrix(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tabclass.plans.queries import QUERIES
    from tabclass.session import ensure_checkpoint_dir

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {k: wrap(v) for k, v in (QUERIES | _training_data()[0]).items()}


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data subpackage and of the pipeline that
    belongs to it; none of a part that isn't installed."""
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    sql: dict[str, str] = {}
    try:
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "tabclass.llm"):
            raise
    try:
        from tabclass.llm import queries as llm

        found |= llm.QUERIES
        sql |= llm.ORACLE_SQL
    except ModuleNotFoundError as e:
        if e.name != "tabclass.llm":
            raise
    return found, sql


# =============================================================== SQL building
D = 6  # rounding digits, as in tabclass/plans/queries.py


def _hash32(expr: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8)) AS BIGINT)"


def _hash_split(expr: str) -> str:
    return f"CASE WHEN {_hash32(expr)} < {round(0.8 * 2**32)} THEN 'train' ELSE 'test' END"


def _to_int(expr: str) -> str:
    """Text -> int as the library's safe cast: via double, truncating."""
    return f"try_cast(trunc(try_cast({expr} AS DOUBLE)) AS INTEGER)"


def _to_long(expr: str) -> str:
    """Integer text -> exact bigint; other numeric text truncated via double
    (DuckDB would round '2.5' when casting text straight to BIGINT)."""
    return (
        f"CASE WHEN regexp_full_match(trim({expr}), '[+-]?[0-9]+') THEN try_cast(trim({expr}) AS BIGINT) "
        f"ELSE try_cast(trunc(try_cast({expr} AS DOUBLE)) AS BIGINT) END"
    )


SALARY_RAW = """
SELECT p_partkey, p_partkey % 1000 AS p_partmod, p_size,
       CASE WHEN p_partkey % 7 = 0 THEN ' ' || p_type ELSE p_type END AS p_type,
       p_brand,
       CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_retailprice END AS salary
FROM part"""

RECIPE_SALARY = f"""
WITH raw AS ({SALARY_RAW}),
nn AS (SELECT * FROM raw WHERE salary IS NOT NULL AND NOT isnan(salary)),
cuts AS (SELECT quantile_disc(salary, CAST(1 AS DOUBLE) / 3) AS q1,
                quantile_disc(salary, CAST(2 AS DOUBLE) / 3) AS q2 FROM nn)
SELECT p_partkey, CAST(p_partmod AS INTEGER) AS p_partmod, CAST(p_size AS INTEGER) AS p_size,
       trim(p_type) AS p_type, trim(p_brand) AS p_brand,
       CASE WHEN salary <= q1 THEN 'Low' WHEN salary <= q2 THEN 'Medium' ELSE 'High' END AS price_tercile
FROM nn CROSS JOIN cuts"""

SOCIAL_RAW = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 19 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       CASE WHEN o_orderkey % 5 = 0 THEN '  ' || o_orderpriority || ' ' ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
FROM orders"""

RECIPE_SOCIAL = f"""
WITH raw AS ({SOCIAL_RAW})
SELECT o_orderkey, {_to_int('o_custkey')} AS o_custkey, try_cast(o_totalprice AS DOUBLE) AS o_totalprice,
       trim(o_orderpriority) AS o_orderpriority, trim(o_orderstatus) AS o_orderstatus
FROM raw WHERE trim(o_orderstatus) IN ('F', 'O', 'P')"""

FRAUD_RAW = """
SELECT event_id,
       CASE WHEN event_id % 29 = 0 THEN 'not a time' ELSE CAST(ts AS VARCHAR) END AS trans_date_trans_time,
       CAST(1950 + user_id % 50 AS VARCHAR) || '-06-15' AS dob,
       CAST((event_id * 37) % 180 - 90 AS DOUBLE) AS lat,
       CAST((event_id * 53) % 360 - 180 AS DOUBLE) AS long,
       CAST((user_id % 25) * 7 - 80 AS DOUBLE) AS merch_lat,
       CAST((user_id % 25) * 14 - 170 AS DOUBLE) AS merch_long,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS amt,
       CAST(user_id % 5 AS VARCHAR) AS category,
       CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       CASE WHEN event_id % 31 = 0 THEN NULL ELSE 'S' || CAST(user_id % 7 AS VARCHAR) END AS state,
       user_id * 1000 AS city_pop,
       'J' || CAST(user_id % 11 AS VARCHAR) AS job,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_fraud
FROM events"""


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    )
    return f"(6371.0 * (2 * atan2(sqrt({a}), sqrt(greatest(0.0, 1 - {a})))))"


RECIPE_FRAUD_FULL = f"""
WITH raw AS ({FRAUD_RAW}),
f AS (SELECT *, try_cast(trans_date_trans_time AS TIMESTAMP) AS t, try_cast(dob AS TIMESTAMP) AS d
      FROM raw WHERE is_fraud IS NOT NULL AND amt IS NOT NULL AND NOT isnan(amt)),
g AS (SELECT event_id, CAST(amt AS DOUBLE) AS amt, category, gender, state,
             try_cast(city_pop AS INTEGER) AS city_pop, job,
             CAST(hour(t) AS INTEGER) AS trans_hour, CAST(dayofweek(t) + 1 AS INTEGER) AS trans_day_of_week,
             CAST(year(t) - year(d) AS INTEGER) AS age,
             {_haversine('lat', 'long', 'merch_lat', 'merch_long')} AS distance_to_merchant,
             CAST(is_fraud AS INTEGER) AS is_fraud
      FROM f)
SELECT * FROM g
WHERE amt IS NOT NULL AND NOT isnan(amt) AND category IS NOT NULL AND gender IS NOT NULL
  AND state IS NOT NULL AND city_pop IS NOT NULL AND job IS NOT NULL AND trans_hour IS NOT NULL
  AND trans_day_of_week IS NOT NULL AND age IS NOT NULL AND distance_to_merchant IS NOT NULL
  AND NOT isnan(distance_to_merchant) AND is_fraud IS NOT NULL"""

MATCHES_RAW = """
SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey, l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
       l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
       CASE WHEN l_linestatus = 'F' THEN (CASE WHEN l_orderkey % 4 = 0 THEN ' 1 ' ELSE '1' END)
            ELSE (CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'NULL' WHEN 2 THEN '' ELSE 'True' END) END AS win
FROM lineitem"""


def _accounting_sql() -> str:
    parts = []
    for name, raw, recipe, numeric in (
        ("orders_social", SOCIAL_RAW, RECIPE_SOCIAL, EXPERIMENTS["orders_social"][3]),
        ("lineitem_matches", MATCHES_RAW, RECIPE_MATCHES, EXPERIMENTS["lineitem_matches"][3]),
    ):
        good = " AND ".join(f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))" for c in numeric)
        steps = (("read", f"({raw})", "TRUE"), ("kept", f"({recipe})", "TRUE"), ("usable", f"({recipe})", good))
        parts += [
            f"SELECT '{name}' AS dataset, '{step}' AS step, CAST({i} AS INTEGER) AS position, (SELECT count(*) FROM {rows} WHERE {where}) AS rows"
            for i, (step, rows, where) in enumerate(steps)
        ]
    return f"SELECT *, lag(rows) OVER (PARTITION BY dataset ORDER BY position) - rows AS dropped FROM ({' UNION ALL '.join(parts)})"


def _recipe_matches(extra_key: bool = False) -> str:
    row = (
        ", concat_ws('|', CAST(l_orderkey AS VARCHAR), l_partkey, CAST(l_suppkey AS VARCHAR), l_linenumber, "
        "CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR)) AS l_row"
        if extra_key
        else ""
    )
    key = "l_row" if extra_key else "l_orderkey"
    return f"""
WITH raw AS (SELECT *{row} FROM ({MATCHES_RAW})),
c AS (SELECT {key}, trim(l_returnflag) AS l_returnflag, {_to_long('l_partkey')} AS l_partkey,
             {_to_int('l_linenumber')} AS l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
             trim(win) AS win FROM raw)
SELECT * REPLACE (CASE WHEN win IS NULL OR win = 'NULL' OR win = '' THEN '0' ELSE win END AS win)
FROM c WHERE (CASE WHEN win IS NULL OR win = 'NULL' OR win = '' THEN '0' ELSE win END) IN ('1', '0')"""


RECIPE_MATCHES = _recipe_matches()

# key, target, numeric, categorical of each stand-in experiment (schema order)
EXPERIMENTS = {
    "orders_social": (RECIPE_SOCIAL, "o_orderkey", "o_orderstatus", ["o_custkey", "o_totalprice"], ["o_orderpriority"]),
    "events_fraud": (
        RECIPE_FRAUD_FULL,
        "event_id",
        "is_fraud",
        ["amt", "city_pop", "trans_hour", "trans_day_of_week", "age", "distance_to_merchant"],
        ["category", "gender", "state", "job"],
    ),
    "lineitem_matches": (
        _recipe_matches(extra_key=True),
        "l_row",
        "win",
        ["l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        ["l_returnflag"],
    ),
    "part_salary": (RECIPE_SALARY, "p_partkey", "price_tercile", ["p_partmod", "p_size"], ["p_type", "p_brand"]),
}


def features_ctes(rec: str, key: str, target: str, numeric: list[str], categorical: list[str]) -> str:
    """CTEs rec, lab, voc<i>, nv<i>, d(k, label, x<j>, c<i>, split): the
    feature pipeline in SQL (frequency-ranked vocabularies over all rows,
    NULL/unseen -> n, numeric NULL/NaN rows skipped, hash split)."""
    parts = [f"rec AS ({rec})"]
    parts.append(
        f"""lab AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS idx
          FROM (SELECT CAST({target} AS VARCHAR) AS v, count(*) AS n FROM rec WHERE {target} IS NOT NULL GROUP BY 1))"""
    )
    parts.append("nlab AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM lab)")
    for i, c in enumerate(categorical):
        parts.append(
            f"""voc{i} AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS BIGINT) AS idx
          FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM rec WHERE {c} IS NOT NULL GROUP BY 1))"""
        )
        parts.append(f"nv{i} AS (SELECT count(*) AS n FROM voc{i})")
    sel = [f"rec.{key} AS k", "COALESCE(lab.idx, nlab.n) AS label"]
    sel += [f"CAST(rec.{c} AS DOUBLE) AS x{j}" for j, c in enumerate(numeric)]
    sel += [f"COALESCE(voc{i}.idx, nv{i}.n) AS c{i}, nv{i}.n AS n{i}" for i in range(len(categorical))]
    sel.append(f"{_hash_split('rec.' + key)} AS split")
    joins = [f"LEFT JOIN lab ON CAST(rec.{target} AS VARCHAR) = lab.v", "CROSS JOIN nlab"]
    for i, c in enumerate(categorical):
        joins.append(f"LEFT JOIN voc{i} ON CAST(rec.{c} AS VARCHAR) = voc{i}.v CROSS JOIN nv{i}")
    where = " AND ".join(f"rec.{c} IS NOT NULL AND NOT isnan(CAST(rec.{c} AS DOUBLE))" for c in numeric) or "TRUE"
    parts.append(f"d AS (SELECT {', '.join(sel)} FROM rec {' '.join(joins)} WHERE {where})")
    return "WITH " + ",\n".join(parts)


def features_array(numeric: list[str], categorical: list[str]) -> str:
    pieces = []
    if numeric:
        pieces.append("[" + ", ".join(f"x{j}" for j in range(len(numeric))) + "]")
    for i in range(len(categorical)):
        pieces.append(f"list_transform(range(n{i}), lambda j: CASE WHEN j = c{i} THEN 1.0 ELSE 0.0 END::DOUBLE)")
    return " || ".join(pieces) if pieces else "[]::DOUBLE[]"


def nb_ctes(numeric: list[str], categorical: list[str]) -> str:
    """Gaussian NB fit on split='train' rows and scores for split='test' rows
    (appended to features_ctes).  MLlib: pi = ln n_c - ln N; theta = mean;
    sigma = population variance + 1e-9 * max_j global population variance;
    score = pi - (sum (x - theta)^2 / sigma + sum ln sigma) / 2; ties -> lower class."""
    p = []
    p.append("tr AS (SELECT * FROM d WHERE split = 'train')")
    p.append("tot AS (SELECT count(*) AS n FROM tr)")
    stats = ", ".join(f"avg(x{j}) AS m{j}, var_pop(x{j}) AS v{j}" for j in range(len(numeric)))
    p.append(f"cls AS (SELECT label, count(*) AS n_c{', ' + stats if stats else ''} FROM tr GROUP BY label)")
    gv = ", ".join(f"var_pop(x{j})" for j in range(len(numeric)))
    p.append(f"gv AS (SELECT {'greatest(' + gv + ', 0.0)' if gv else '0.0'} AS g FROM tr)")
    for i in range(len(categorical)):
        p.append(f"slots{i} AS (SELECT unnest(range((SELECT max(n{i}) FROM d))) AS j)")
        p.append(f"cnt{i} AS (SELECT label, c{i} AS j, count(*) AS c FROM tr GROUP BY 1, 2)")
        p.append(
            f"""sl{i} AS (SELECT cls.label, s.j, CAST(COALESCE(cnt.c, 0) AS DOUBLE) / cls.n_c AS mu
          FROM cls CROSS JOIN slots{i} s LEFT JOIN cnt{i} cnt ON cnt.label = cls.label AND cnt.j = s.j)"""
        )
        p.append(
            f"""gs{i} AS (SELECT COALESCE(max(q * (1 - q)), 0.0) AS g FROM (
          SELECT CAST(COALESCE(sum(cnt.c), 0) AS DOUBLE) / (SELECT n FROM tot) AS q
          FROM slots{i} s LEFT JOIN cnt{i} cnt ON cnt.j = s.j GROUP BY s.j))"""
        )
    gs = "".join(f", gs{i}.g" for i in range(len(categorical)))
    gfrom = "".join(f" CROSS JOIN gs{i}" for i in range(len(categorical)))
    p.append(f"eps AS (SELECT 1e-9 * greatest(gv.g{gs}) AS e FROM gv{gfrom})")
    for i in range(len(categorical)):
        p.append(f"sp{i} AS (SELECT label, j, mu, mu - mu * mu + (SELECT e FROM eps) AS sig FROM sl{i})")
        p.append(f"b{i} AS (SELECT label, sum(mu * mu / sig) AS base, sum(ln(sig)) AS logv FROM sp{i} GROUP BY label)")
    quad = [f"pow(te.x{j} - cls.m{j}, 2) / (cls.v{j} + eps.e) + ln(cls.v{j} + eps.e)" for j in range(len(numeric))]
    for i in range(len(categorical)):
        quad.append(f"b{i}.base + b{i}.logv + COALESCE((1 - 2 * k{i}.mu) / k{i}.sig, 0.0)")
    joins = "".join(
        f" JOIN b{i} ON b{i}.label = cls.label LEFT JOIN sp{i} k{i} ON k{i}.label = cls.label AND k{i}.j = te.c{i}"
        for i in range(len(categorical))
    )
    p.append(
        f"""sc AS (SELECT te.k, te.label, cls.label AS cl,
          ln(cls.n_c) - ln(tot.n) - 0.5 * ({' + '.join(quad) or '0.0'}) AS score
          FROM d te CROSS JOIN cls CROSS JOIN tot CROSS JOIN eps{joins} WHERE te.split = 'test')"""
    )
    p.append(
        """pred AS (SELECT k, label, cl AS prediction FROM (
          SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, cl) AS rn FROM sc) WHERE rn = 1)"""
    )
    return ",\n" + ",\n".join(p)


def nb_sql(name: str) -> str:
    rec, key, target, num, cat = EXPERIMENTS[name]
    return features_ctes(rec, key, target, num, cat) + nb_ctes(num, cat)


def scores_sql(pred: str = "pred") -> str:
    """accuracy and weighted F1 (MLlib MulticlassMetrics) from a (label, prediction) relation."""
    return f"""
cm AS (SELECT label, prediction, count(*) AS n FROM {pred} GROUP BY 1, 2),
act AS (SELECT label AS cl, CAST(sum(n) AS BIGINT) AS support,
               CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS BIGINT) AS tp FROM cm GROUP BY 1),
prd AS (SELECT prediction AS cl, CAST(sum(n) AS BIGINT) AS predicted FROM cm GROUP BY 1),
pc AS (SELECT act.cl, support, tp, COALESCE(predicted, 0) AS predicted,
              CASE WHEN COALESCE(predicted, 0) > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS p,
              CAST(tp AS DOUBLE) / support AS r FROM act LEFT JOIN prd ON act.cl = prd.cl),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END AS f1 FROM pc),
sc2 AS (SELECT CAST(sum(tp) AS DOUBLE) / sum(support) AS accuracy,
               sum(f1 * support) / sum(support) AS weighted_f1, CAST(sum(support) AS BIGINT) AS n FROM f)"""


SALARY_FEATS = features_ctes(*EXPERIMENTS["part_salary"][:5])
SOCIAL_FEATS = features_ctes(*EXPERIMENTS["orders_social"][:5])
SALARY_NB = nb_sql("part_salary")


def _experiment_rows(datasets: list[str], partitions: list[int]) -> str:
    """Quality columns of NB experiment rows, one block per (partitions, dataset)."""
    blocks = []
    for part in partitions:
        for ds in datasets:
            blocks.append(
                f"""SELECT * FROM ({nb_sql(ds)}, {scores_sql()[1:]}
SELECT '{ds}' AS dataset, 'naive_bayes' AS classifier, 1 AS workers, {part} AS partitions,
       round(accuracy, {D}) AS accuracy, round(weighted_f1, {D}) AS f1, 'ok' AS status FROM sc2)"""
            )
    return "\nUNION ALL\n".join(blocks)


def _profile_sql() -> str:
    blocks = []
    for name, (rec, _k, target, num, cat) in EXPERIMENTS.items():
        if name == "lineitem_matches":
            rec, ncols = RECIPE_MATCHES, 9
        elif name == "events_fraud":
            ncols = 12
        else:
            ncols = 1 + len(num) + len(cat) + 1
        blocks.append(
            f"""SELECT '{name}' AS dataset, count(*) AS rows, {ncols} AS columns, '{target}' AS target,
       count(*) FILTER (WHERE {target} IS NULL) AS target_nulls FROM ({rec})"""
        )
    return "\nUNION ALL\n".join(blocks)


def _profile_wide_sql() -> str:
    tables = {
        "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
        "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
        "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    }
    empty = {"l_returnflag": "nullif(l_returnflag, 'N')", "o_orderstatus": "nullif(o_orderstatus, 'P')", "p_size": "nullif(p_size, 7)"}
    blocks = []
    for t, columns in tables.items():
        for c in columns.split():
            # + 0: the least value may come from a file's statistics, which write zero as -0.0
            v = f"({c} + 0)" if c in ("l_discount", "l_tax") else empty.get(c, c)
            blocks.append(
                f"""SELECT '{t}' AS dataset, '{c}' AS "column", count(*) AS rows, count(*) - count({v}) AS nulls,
       CAST(min({v}) AS VARCHAR) AS min_value, CAST(max({v}) AS VARCHAR) AS max_value, TRUE AS distinct_within_error,
       coalesce((SELECT string_agg(w || ':' || n, ',' ORDER BY n DESC, w) FROM (SELECT CAST({v} AS VARCHAR) AS w, count(*) AS n FROM {t}
        WHERE {v} IS NOT NULL GROUP BY 1) WHERE n >= 0.01 * (SELECT count(*) FROM {t})), '') AS heavy FROM {t}"""
            )
    return "\nUNION ALL\n".join(blocks)


_NUMERIC_DUCK = "('TINYINT','SMALLINT','INTEGER','BIGINT','HUGEINT','FLOAT','DOUBLE','REAL','UTINYINT','USMALLINT','UINTEGER','UBIGINT')"


def _roles_sql() -> str:
    blocks = []
    for table, target in [
        ("orders", "o_orderstatus"),
        ("lineitem", "l_linestatus"),
        ("part", "p_type"),
        ("events", "event_type"),
        ("customer", "c_mktsegment"),
    ]:
        blocks.append(
            f"""SELECT '{table}' AS table_name, column_name AS "column",
       CASE WHEN column_name = '{target}' THEN 'target'
            WHEN data_type IN {_NUMERIC_DUCK} OR data_type LIKE 'DECIMAL%' THEN 'numeric'
            WHEN data_type = 'VARCHAR' THEN 'categorical' ELSE 'ignored' END AS role, ordinal_position
FROM information_schema.columns WHERE table_name = '{table}'"""
        )
    return f"""SELECT table_name, "column", role,
       CAST(row_number() OVER (PARTITION BY table_name, role ORDER BY ordinal_position) - 1 AS INTEGER) AS position
FROM ({' UNION ALL '.join(blocks)})"""


def _schema_sql() -> str:
    blocks = []
    for name, (rec, _k, target, _n, _c) in EXPERIMENTS.items():
        if name == "lineitem_matches":
            rec = RECIPE_MATCHES
        blocks.append(
            f"""SELECT '{name}' AS dataset, CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS "column",
       CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
                        WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS data_type,
       column_name = '{target}' AS is_target
FROM (DESCRIBE {rec})"""
        )
    return "\nUNION ALL\n".join(blocks)


EVENT_RUNS = """
WITH rows AS (
  SELECT event_type AS dataset, (['random_forest', 'decision_tree', 'naive_bayes'])[user_id % 3 + 1] AS classifier, CAST(1 AS INTEGER) AS workers,
         CAST(([1, 4, 8])[event_id % 3 + 1] AS INTEGER) AS partitions, CASE WHEN user_id % 7 = 0 THEN 'error' ELSE 'ok' END AS status, value FROM events),
runs AS (
  SELECT dataset, classifier, workers, partitions, status, round(sum(value), 3) AS train, count(*) / 8 AS predict, CAST(0.5 AS DOUBLE) AS accuracy
  FROM rows WHERE NOT (classifier = 'naive_bayes' AND dataset = 'view' AND partitions = 1) GROUP BY ALL)"""


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    # ---------------------------------------------------------------- sources
    o["scan_csv"] = o["scan_csv_records"] = "SELECT * FROM documents"
    o["dataset_catalog"] = """
SELECT CAST(position AS INTEGER) AS position, name, source_table, target_column, size_category, source_rows FROM (
  SELECT 0 AS position, 'orders_social' AS name, 'orders' AS source_table, 'o_orderstatus' AS target_column, 'medium' AS size_category, (SELECT count(*) FROM orders) AS source_rows
  UNION ALL SELECT 1, 'events_fraud', 'events', 'is_fraud', 'large', (SELECT count(*) FROM events)
  UNION ALL SELECT 2, 'lineitem_matches', 'lineitem', 'win', 'large', (SELECT count(*) FROM lineitem)
  UNION ALL SELECT 3, 'part_salary', 'part', 'price_tercile', 'medium', (SELECT count(*) FROM part))"""
    o["repartition_rows"] = "SELECT * FROM part"
    o["metrics_sink"] = _experiment_rows(["part_salary", "orders_social"], [-1])
    o["results_union"] = _experiment_rows(["part_salary"], [2, 4])
    # ---------------------------------------------------------------- columns
    o["drop_columns"] = (
        "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag FROM lineitem"
    )
    o["cast_int"] = f"SELECT o_orderkey, {_to_int('o_custkey')} AS o_custkey, {_to_int('o_totalprice')} AS o_totalprice FROM ({SOCIAL_RAW})"
    o["cast_long"] = f"""SELECT l_orderkey, {_to_long('l_partkey')} AS l_partkey,
       {_to_long('CAST(l_extendedprice AS VARCHAR)')} AS l_extendedprice, {_to_long('win')} AS win FROM ({MATCHES_RAW})"""
    o["cast_double"] = (
        f"SELECT o_orderkey, try_cast(o_custkey AS DOUBLE) AS o_custkey, try_cast(o_totalprice AS DOUBLE) AS o_totalprice FROM ({SOCIAL_RAW})"
    )
    o["trim_categoricals"] = (
        f"SELECT o_orderkey, trim(o_orderpriority) AS o_orderpriority, trim(o_orderstatus) AS o_orderstatus FROM ({SOCIAL_RAW})"
    )
    o["select_contract"] = f"""SELECT o_orderstatus, CAST(o_orderkey AS BIGINT) AS o_orderkey, {_to_int('o_custkey')} AS o_custkey,
       try_cast(o_totalprice AS DOUBLE) AS o_totalprice FROM ({SOCIAL_RAW})"""
    o["rename_snake_case"] = (
        "SELECT c_custkey, c_name, c_nationkey AS c_nationkey, c_acctbal, c_mktsegment AS c_mkt_segment FROM customer"
    )
    o["infer_column_roles"] = _roles_sql()
    # ------------------------------------------------------------------- rows
    o["dropna_subset"] = f"SELECT * FROM ({SOCIAL_RAW}) WHERE o_orderstatus IS NOT NULL"
    o["dropna_any"] = f"""SELECT * FROM ({FRAUD_RAW}) WHERE amt IS NOT NULL AND NOT isnan(amt) AND state IS NOT NULL
  AND trans_date_trans_time IS NOT NULL AND dob IS NOT NULL"""
    o["filter_allowed"] = (
        f"SELECT l_orderkey, l_partkey, l_linenumber, l_linestatus, win FROM ({MATCHES_RAW}) WHERE win IN ('1', '0')"
    )
    o["impute_target_default"] = f"""SELECT l_orderkey, l_partkey, l_linenumber,
       CASE WHEN trim(win) IS NULL OR trim(win) IN ('NULL', '') THEN '0' ELSE trim(win) END AS win FROM ({MATCHES_RAW})"""
    o["skip_invalid_rows"] = f"SELECT * FROM ({RECIPE_SOCIAL}) WHERE o_custkey IS NULL OR o_totalprice IS NULL OR isnan(o_totalprice)"
    o["assemble_features"] = (
        SOCIAL_FEATS + f"\nSELECT k AS o_orderkey, {features_array(*EXPERIMENTS['orders_social'][3:5])} AS features FROM d"
    )
    # ---------------------------------------------------------------- scalars
    o["parse_timestamp"] = (
        f"SELECT event_id, try_cast(trans_date_trans_time AS TIMESTAMP) AS trans_ts, try_cast(dob AS TIMESTAMP) AS dob_ts FROM ({FRAUD_RAW})"
    )
    o["calendar_features"] = (
        "SELECT event_id, CAST(hour(ts) AS INTEGER) AS trans_hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS trans_day_of_week FROM events"
    )
    o["year_diff"] = f"""SELECT event_id,
       CAST(year(try_cast(trans_date_trans_time AS TIMESTAMP)) - year(try_cast(dob AS TIMESTAMP)) AS INTEGER) AS age FROM ({FRAUD_RAW})"""
    lat1, lon1 = "CAST((c_custkey * 37) % 180 - 90 AS DOUBLE)", "CAST((c_custkey * 53) % 360 - 180 AS DOUBLE)"
    lat2, lon2 = "CAST(c_nationkey * 7 - 80 AS DOUBLE)", "CAST(c_nationkey * 14 - 170 AS DOUBLE)"
    o["haversine_km"] = f"""SELECT c_custkey,
       round({_haversine(lat1, lon1, lat2, lon2)}, {D}) AS distance_km,
       round({_haversine(lat2, lon2, lat1, lon1)}, {D}) AS distance_back_km,
       round({_haversine(lat1, lon1, lat1, lon1)}, {D}) AS distance_self_km FROM customer"""
    # ------------------------------------------------------------- statistics
    o["profile_table"] = _profile_sql()
    o["tercile_target"] = f"""
WITH raw AS ({SALARY_RAW}),
nn AS (SELECT * FROM raw WHERE salary IS NOT NULL AND NOT isnan(salary)),
cuts AS (SELECT quantile_disc(salary, CAST(1 AS DOUBLE) / 3) AS q1, quantile_disc(salary, CAST(2 AS DOUBLE) / 3) AS q2 FROM nn),
t AS (SELECT salary, CASE WHEN salary <= q1 THEN 'Low' WHEN salary <= q2 THEN 'Medium' ELSE 'High' END AS price_tercile, q1, q2
      FROM nn CROSS JOIN cuts)
SELECT price_tercile, count(*) AS n, min(salary) AS min_salary, max(salary) AS max_salary, any_value(q1) AS q1, any_value(q2) AS q2
FROM t GROUP BY price_tercile"""
    probs = ["0.01", "0.25", "CAST(1 AS DOUBLE) / 3", "0.5", "CAST(2 AS DOUBLE) / 3", "0.75", "0.99"]
    o["quantiles_exact"] = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS i, CAST({p} AS DOUBLE) AS p, "
        f"CAST(quantile_disc(l_extendedprice, {p}) AS DOUBLE) AS q FROM lineitem"
        for i, p in enumerate(probs)
    )
    o["sample_rows"] = f"SELECT * FROM ({RECIPE_SOCIAL}) ORDER BY o_orderkey LIMIT 5"
    o["schema_report"] = _schema_sql()
    # --------------------------------------------------------------- features
    o["label_index"] = SALARY_FEATS + "\nSELECT rec.p_partkey, rec.price_tercile, lab.idx AS label FROM rec JOIN lab ON rec.price_tercile = lab.v"
    o["category_index"] = (
        SALARY_FEATS
        + "\nSELECT rec.p_partkey, CAST(COALESCE(voc0.idx, nv0.n) AS DOUBLE) AS p_type_idx, CAST(COALESCE(voc1.idx, nv1.n) AS DOUBLE) AS p_brand_idx"
        " FROM rec LEFT JOIN voc0 ON rec.p_type = voc0.v CROSS JOIN nv0 LEFT JOIN voc1 ON rec.p_brand = voc1.v CROSS JOIN nv1"
    )
    o["one_hot"] = (
        SALARY_FEATS
        + "\nSELECT k AS p_partkey, list_transform(range(n0), lambda j: CASE WHEN j = c0 THEN 1.0 ELSE 0.0 END::DOUBLE) AS p_type_ohe,"
        " list_transform(range(n1), lambda j: CASE WHEN j = c1 THEN 1.0 ELSE 0.0 END::DOUBLE) AS p_brand_ohe FROM d"
    )
    o["build_features"] = (
        SALARY_FEATS + f"\nSELECT k AS p_partkey, label, {features_array(*EXPERIMENTS['part_salary'][3:5])} AS features, split FROM d"
    )
    # ----------------------------------------------------------------- splits
    o["hash_split"] = f"SELECT p_partkey, {_hash_split('p_partkey')} AS split FROM part"
    o["stratified_split"] = f"""
WITH r AS (SELECT o_orderkey, o_orderstatus, {_hash32('o_orderkey')} AS h FROM ({RECIPE_SOCIAL}))
SELECT o_orderkey, o_orderstatus,
       CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey)
                 <= round(count(*) OVER (PARTITION BY o_orderstatus) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
FROM r"""
    # ------------------------------------------------------- models, metrics
    o["predict_naive_bayes"] = SALARY_NB + "\nSELECT k AS p_partkey, label, prediction FROM pred"
    o["confusion_matrix"] = SALARY_NB + "\nSELECT label, prediction, count(*) AS n FROM pred GROUP BY 1, 2"
    o["per_class_metrics"] = SALARY_NB + "," + scores_sql()[1:] + f"""
SELECT cl AS class, support, predicted, tp, round(p, {D}) AS precision, round(r, {D}) AS recall, round(f1, {D}) AS f1 FROM f"""
    o["eval_accuracy"] = SALARY_NB + "," + scores_sql()[1:] + f"\nSELECT round(accuracy, {D}) AS accuracy FROM sc2"
    o["eval_weighted_f1"] = SALARY_NB + "," + scores_sql()[1:] + f"\nSELECT round(weighted_f1, {D}) AS weighted_f1 FROM sc2"
    o["train_and_evaluate"] = (
        SALARY_NB + "," + scores_sql()[1:] + f"\nSELECT round(accuracy, {D}) AS accuracy, round(weighted_f1, {D}) AS f1, n FROM sc2"
    )
    num, cat = EXPERIMENTS["part_salary"][3:5]
    theta_rows = [f"SELECT label AS class, {j} AS feature, m{j} AS theta, v{j} AS v FROM cls" for j in range(len(num))]
    offset = len(num)
    for i in range(len(cat)):
        theta_rows.append(
            f"SELECT label AS class, (SELECT {offset} ) + j {''.join(f'+ (SELECT max(n{q}) FROM d)' for q in range(i))} AS feature, mu AS theta, mu - mu * mu AS v FROM sl{i}"
        )
    o["train_naive_bayes"] = SALARY_NB + f"""
SELECT t.class, CAST(t.feature AS INTEGER) AS feature, round(ln(cls.n_c) - ln(tot.n), {D}) AS pi,
       round(t.theta, {D}) AS theta, round(t.v + eps.e, {D}) AS sigma
FROM ({' UNION ALL '.join(theta_rows)}) t JOIN cls ON cls.label = t.class CROSS JOIN tot CROSS JOIN eps"""
    # ---------------------------------------------------------- experiments
    o["run_experiments_nb"] = _experiment_rows(list(EXPERIMENTS), [-1])
    sizes = " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, (SELECT count(*) FROM ({RECIPE_MATCHES if n == 'lineitem_matches' else e[0]})) AS rows"
        for n, e in EXPERIMENTS.items()
    )
    o["experiment_grid"] = f"""SELECT s.dataset, c.classifier, s.rows FROM ({sizes}) s CROSS JOIN
  (SELECT 'random_forest' AS classifier UNION ALL SELECT 'decision_tree' UNION ALL SELECT 'naive_bayes') c"""
    # ---------------------------------------------------------------- recipes
    o["recipe_social"] = RECIPE_SOCIAL
    o["recipe_fraud"] = f"SELECT * REPLACE (round(distance_to_merchant, {D}) AS distance_to_merchant) FROM ({RECIPE_FRAUD_FULL})"
    o["recipe_matches"] = RECIPE_MATCHES
    o["recipe_salary"] = RECIPE_SALARY
    # ------------------------------------------- invariants and metrics rows
    o["quantiles_approx"] = "SELECT * FROM (VALUES (CAST(0.333333 AS DOUBLE), TRUE), (CAST(0.666667 AS DOUBLE), TRUE)) t(p, within_error)"
    o["category_index_large"] = """
WITH o AS (SELECT l_orderkey AS k, row_number() OVER (ORDER BY count(*) DESC, CAST(l_orderkey AS VARCHAR)) - 1 AS idx FROM lineitem GROUP BY 1),
p AS (SELECT l_partkey AS k, row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS idx FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(o.idx AS DOUBLE) AS l_orderkey_idx, CAST(p.idx AS DOUBLE) AS l_partkey_idx
FROM lineitem JOIN o ON o.k = l_orderkey JOIN p ON p.k = l_partkey"""
    o["quantiles_sketch"] = """
SELECT l_returnflag, l_linestatus, count(*) AS n, p, TRUE AS within_error
FROM lineitem, (VALUES (CAST(0.333333 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(0.666667 AS DOUBLE))) t(p) GROUP BY l_returnflag, l_linestatus, p"""
    o["eval_many_classes"] = f"""
WITH p AS (SELECT l_partkey AS y, CASE WHEN l_linenumber < 3 THEN l_partkey ELSE l_suppkey * 7 END AS p FROM lineitem),
s AS (SELECT y, count(*) AS support, count(*) FILTER (y = p) AS tp FROM p GROUP BY y),
q AS (SELECT p, count(*) AS predicted FROM p GROUP BY p)
SELECT round(CAST(sum(tp) AS DOUBLE) / sum(support), {D}) AS accuracy,
       round(sum(2.0::DOUBLE * tp / (support + coalesce(predicted, 0)) * support) / sum(support), {D}) AS weighted_f1,
       CAST(sum(support) AS BIGINT) AS n, count(*) AS classes FROM s LEFT JOIN q ON q.p = s.y"""
    o["row_accounting"] = _accounting_sql()
    o["profile_wide"] = _profile_wide_sql()
    o["random_split"] = "SELECT p_partkey, count(*) AS sides, TRUE AS share_ok FROM part GROUP BY p_partkey"
    for key in ("train_random_forest", "train_decision_tree", "train_any_estimator"):
        o[key] = SALARY_NB + "\nSELECT k AS p_partkey, label, TRUE AS in_classes, TRUE AS beats_majority FROM pred"
    o["run_experiments"] = """
SELECT 'part_salary' AS dataset, c AS classifier, CAST(1 AS INTEGER) AS workers, CAST(-1 AS INTEGER) AS partitions, 'ok' AS status,
       TRUE AS accuracy_ok, TRUE AS f1_ok, TRUE AS times_ok FROM (VALUES ('random_forest'), ('decision_tree'), ('naive_bayes')) t(c)"""
    o["run_experiments_together"] = """
SELECT 'part_salary' AS dataset, c AS classifier, CAST(1 AS INTEGER) AS workers, CAST(-1 AS INTEGER) AS partitions, 'ok' AS status,
       TRUE AS as_serial FROM (VALUES ('naive_bayes'), ('decision_tree'), ('naive_bayes_again')) t(c)"""
    o["results_table"] = EVENT_RUNS + f"\nSELECT dataset, classifier, workers, partitions, status, accuracy, round(train + predict, {D}) AS total_time_s FROM runs"
    o["metrics_total_time"] = EVENT_RUNS + f"\nSELECT dataset, classifier, partitions, status, round(train + predict, {D}) AS total_time_s FROM runs"
    o["time_by_classifier"] = EVENT_RUNS + f"""
SELECT classifier, round(sum(train + predict), {D}) AS total_time_s, count(*) AS experiments FROM runs WHERE status = 'ok' GROUP BY classifier"""
    o["sweep_speedup"] = EVENT_RUNS + f"""
SELECT r.dataset, r.classifier, r.workers, r.partitions, round(r.train + r.predict, {D}) AS total_time_s,
       round(b.train + b.predict, {D}) AS base_time_s, round((b.train + b.predict) / nullif(r.train + r.predict, 0), {D}) AS speedup
FROM runs r LEFT JOIN runs b ON b.dataset = r.dataset AND b.classifier = r.classifier AND b.partitions = 1 AND b.status = 'ok'
WHERE r.status = 'ok'"""
    return o | _training_data()[1]
