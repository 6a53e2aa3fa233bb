"""The checked queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each query reads the driver tables (whole tables, never a subset) and runs one
operator or recipe of the library on them.  Floating results of
transcendental functions are rounded to 6 decimals for the comparison with
DuckDB (different libm implementations differ in the last bits); the library
itself never rounds.
"""
from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabclass.functions import (
    day_of_week,
    haversine_km,
    hour_of_day,
    parse_timestamp,
    year_diff,
)
from tabclass.operators import columns as C
from tabclass.operators import rows as R
from tabclass.operators.evaluate import class_counts, class_scores, confusion_matrix, evaluate, per_class_metrics
from tabclass.operators.features import (
    FEATURES_COL,
    build_features,
    fit_vocabularies,
    label_indexer,
    with_feature_array,
)
from tabclass.operators.accounting import RowAccount, account_frame
from tabclass.operators.partitioning import repartition_rows, spread_rows
from tabclass.operators.profile import profile_table, sample_rows, schema_frame
from tabclass.operators.quantiles import TERCILE_LABELS, approx_quantiles, bin_by_cut_points, exact_quantiles
from tabclass.operators.quantile_sketch import merge_sketches, quantile_sketches, sketch_quantiles
from tabclass.operators.split import hash_split, random_split, split_frames, stratified_split
from tabclass.operators.rows import valid
from tabclass.operators.wide_profile import DISTINCT_ERROR, wide_profile
from tabclass.operators.vocabulary import fit_vocabulary_table, index_columns
from tabclass.plans import recipes as R_
from tabclass.plans import standins as S
from tabclass.plans.experiments import RunConfig, run_experiments
from tabclass.plans.models import (
    ClassifierRegistry,
    decision_tree,
    default_classifiers,
    logistic_regression,
    naive_bayes,
    random_forest,
)
from tabclass.plans.results import sweep_speedup, time_by_classifier, total_time
from tabclass.session import scratch_path
from tabclass.sources.catalog import DatasetSpec, catalog_frame
from tabclass.sources.csv_records import read_csv_records
from tabclass.sources.files import read_csv, write_csv
from tabclass.sources.leases import leased_table, release
from tabclass.sources.metrics_store import MetricsSink, metrics_frame, read_metrics, run_folder

DIGITS = 6


def _r(col, name=None):
    c = F.round(F.col(col) if isinstance(col, str) else col, DIGITS)
    return c.alias(name or (col if isinstance(col, str) else "value"))


# ------------------------------------------------------------ sources
def q_scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    docs = S.table(spark, sf, "documents")
    path = scratch_path(spark, "scan_csv")
    write_csv(docs, path)
    return read_csv(spark, path, schema=docs.schema, multi_line=True)


def q_scan_csv_records(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, newlines and all, written to CSV, a file a partition, and read by
    many tasks, several to a file where it is large."""
    docs = S.table(spark, sf, "documents")
    path = scratch_path(spark, "scan_csv_records")
    write_csv(docs, path)
    return read_csv_records(spark, path, docs.schema)


STANDIN_SPECS = [
    DatasetSpec("orders_social", "orders", S.SOCIAL.target, "medium"),
    DatasetSpec("events_fraud", "events", "is_fraud", "large"),
    DatasetSpec("lineitem_matches", "lineitem", "win", "large"),
    DatasetSpec("part_salary", "part", S.SALARY.target, "medium"),
]


def q_dataset_catalog(spark: SparkSession, sf: str) -> DataFrame:
    cat = catalog_frame(spark, STANDIN_SPECS)
    sizes = None
    for spec in STANDIN_SPECS:
        n = S.table(spark, sf, spec.path).agg(F.count(F.lit(1)).alias("source_rows")).select(
            F.lit(spec.name).alias("name"), "source_rows"
        )
        sizes = n if sizes is None else sizes.unionByName(n)
    return cat.join(sizes, "name").select(
        "position", "name", F.col("path").alias("source_table"), "target_column", "size_category", "source_rows"
    )


def q_repartition_rows(spark: SparkSession, sf: str) -> DataFrame:
    return repartition_rows(S.table(spark, sf, "part"), 4)


# ---------------------------------------------------------- columns
def q_drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    return C.drop_columns(S.table(spark, sf, "lineitem"), S.MATCHES.drop)


def q_cast_int(spark: SparkSession, sf: str) -> DataFrame:
    raw = S.social_raw(spark, sf)
    return C.cast_int(raw, ["o_custkey", "o_totalprice"]).select("o_orderkey", "o_custkey", "o_totalprice")


def q_cast_long(spark: SparkSession, sf: str) -> DataFrame:
    raw = S.matches_raw(spark, sf).select(
        "l_orderkey", "l_partkey", F.col("l_extendedprice").cast("string").alias("l_extendedprice"), "win"
    )
    return C.cast_long(raw, ["l_partkey", "l_extendedprice", "win"])


def q_cast_double(spark: SparkSession, sf: str) -> DataFrame:
    raw = S.social_raw(spark, sf)
    return C.cast_double(raw, ["o_custkey", "o_totalprice"]).select("o_orderkey", "o_custkey", "o_totalprice")


def q_trim_categoricals(spark: SparkSession, sf: str) -> DataFrame:
    raw = S.social_raw(spark, sf)
    return C.trim_strings(raw, ["o_orderpriority", "o_orderstatus"]).select(
        "o_orderkey", "o_orderpriority", "o_orderstatus"
    )


def q_select_contract(spark: SparkSession, sf: str) -> DataFrame:
    raw = S.social_raw(spark, sf)
    return C.select_contract(
        raw,
        [("o_orderstatus", "string"), ("o_orderkey", "long"), ("o_custkey", "int"), ("o_totalprice", "double")],
    )


def q_rename_snake_case(spark: SparkSession, sf: str) -> DataFrame:
    cust = S.table(spark, sf, "customer").toDF(" C_CustKey", "C Name", "c NationKey ", "C_ACCTBAL", "C Mkt Segment")
    return C.rename_snake_case(cust)


ROLE_TABLES = [("orders", "o_orderstatus"), ("lineitem", "l_linestatus"), ("part", "p_type"), ("events", "event_type"), ("customer", "c_mktsegment")]


def q_infer_column_roles(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for name, target in ROLE_TABLES:
        roles = C.infer_column_roles(S.table(spark, sf, name).schema, target)
        df = C.roles_frame(spark, roles).select(F.lit(name).alias("table_name"), "*")
        out = df if out is None else out.unionByName(df)
    return out


# ------------------------------------------------------------- rows
def q_dropna_subset(spark: SparkSession, sf: str) -> DataFrame:
    return R.dropna_subset(S.social_raw(spark, sf), ["o_orderstatus"])


def q_dropna_any(spark: SparkSession, sf: str) -> DataFrame:
    return R.dropna_any(S.fraud_raw(spark, sf))


def q_filter_allowed(spark: SparkSession, sf: str) -> DataFrame:
    raw = S.matches_raw(spark, sf).select("l_orderkey", "l_partkey", "l_linenumber", "l_linestatus", "win")
    return R.filter_allowed(raw, "win", ["1", "0"])


def q_impute_target_default(spark: SparkSession, sf: str) -> DataFrame:
    raw = C.trim_strings(S.matches_raw(spark, sf).select("l_orderkey", "l_partkey", "l_linenumber", "win"), ["win"])
    return R.impute_target_default(raw, "win", "0")


def _social_features(spark: SparkSession, sf: str):
    rec = S.recipe_social(spark, sf)
    return build_features(rec, S.SOCIAL.target, exclude=[S.SOCIAL_KEY])


def q_skip_invalid_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows the assembler skips (a NULL or NaN numeric)."""
    rec = S.recipe_social(spark, sf)
    roles = C.infer_column_roles(rec.schema, S.SOCIAL.target, exclude=[S.SOCIAL_KEY])
    return R.invalid_rows(rec, roles.numeric)


def q_assemble_features(spark: SparkSession, sf: str) -> DataFrame:
    feats, _ = _social_features(spark, sf)
    return with_feature_array(feats.select(S.SOCIAL_KEY, FEATURES_COL))


# ---------------------------------------------------------- scalars
def q_parse_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    raw = S.fraud_raw(spark, sf)
    return raw.select(
        "event_id",
        parse_timestamp("trans_date_trans_time").alias("trans_ts"),
        parse_timestamp("dob").alias("dob_ts"),
    )


def q_calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    ev = S.table(spark, sf, "events")
    return ev.select("event_id", hour_of_day("ts").alias("trans_hour"), day_of_week("ts").alias("trans_day_of_week"))


def q_year_diff(spark: SparkSession, sf: str) -> DataFrame:
    raw = S.fraud_raw(spark, sf)
    return raw.select(
        "event_id", year_diff(parse_timestamp("trans_date_trans_time"), parse_timestamp("dob")).alias("age")
    )


def q_haversine_km(spark: SparkSession, sf: str) -> DataFrame:
    c = S.table(spark, sf, "customer")
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    lat1, lon1 = (k * 37) % 180 - 90, (k * 53) % 360 - 180
    lat2, lon2 = n * 7 - 80, n * 14 - 170
    return c.select(
        "c_custkey",
        _r(haversine_km(lat1, lon1, lat2, lon2), "distance_km"),
        _r(haversine_km(lat2, lon2, lat1, lon1), "distance_back_km"),
        _r(haversine_km(lat1, lon1, lat1, lon1), "distance_self_km"),
    )


# ------------------------------------------------------- statistics
RECIPES = {
    "orders_social": (S.recipe_social, S.SOCIAL.target),
    "events_fraud": (S.recipe_fraud, "is_fraud"),
    "lineitem_matches": (S.recipe_matches, "win"),
    "part_salary": (S.recipe_salary, S.SALARY.target),
}


def q_profile_table(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for name, (fn, target) in RECIPES.items():
        p = profile_table(fn(spark, sf), name, target)
        out = p if out is None else out.unionByName(p)
    return out


def q_quantiles_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate terciles of a whole column: is each one's rank within the
    error that was asked for?"""
    part = S.table(spark, sf, "part")
    error = 0.01
    out = None
    for p, v in zip((1 / 3, 2 / 3), approx_quantiles(part, "p_retailprice", [1 / 3, 2 / 3], error)):
        below, upto = F.avg((F.col("p_retailprice") < v).cast("int")), F.avg((F.col("p_retailprice") <= v).cast("int"))
        row = part.agg(F.lit(round(p, DIGITS)).alias("p"), ((below <= p + error) & (upto >= p - error)).alias("within_error"))
        out = row if out is None else out.unionByName(row)
    return out


def q_quantiles_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles of groups from stored sketches of four parts of ``lineitem``, merged:
    is each one's rank within the error that was asked for?"""
    li, by, error = S.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], 0.01
    parts = [quantile_sketches(li.where(F.col("l_orderkey") % 4 == i), "l_extendedprice", by, error) for i in range(4)]
    stored = leased_table(functools.reduce(DataFrame.unionByName, parts), "sketches")
    found = sketch_quantiles(merge_sketches(stored, by), [1 / 3, 0.5, 2 / 3])
    found = found.select(*by, "n", F.posexplode("quantiles").alias("i", "v"))
    p = F.element_at(F.array(F.lit(1 / 3), F.lit(0.5), F.lit(2 / 3)), F.col("i") + 1)
    ranks = li.select(*by, "l_extendedprice").join(F.broadcast(found), by).groupBy(*by, "i", "n", "v").agg(
        F.avg((F.col("l_extendedprice") < F.col("v")).cast("int")).alias("below"), F.avg((F.col("l_extendedprice") <= F.col("v")).cast("int")).alias("upto")
    )
    # The stated error holds with 99 % confidence for one rank, twice of it for all.
    return ranks.select(*by, "n", F.round(p, DIGITS).alias("p"), ((F.col("below") <= p + 2 * error) & (F.col("upto") >= p - 2 * error)).alias("within_error"))


def q_row_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Rows read, kept by the normalisation and usable for the assembler, for each
    recipe, counted while its rows are written."""
    accounts = []
    for name, raw, normalize, numeric in (
        ("orders_social", S.social_raw, lambda df: R_.normalize_social(df, S.SOCIAL, keep=(S.SOCIAL_KEY,)), ["o_custkey", "o_totalprice"]),
        ("lineitem_matches", S.matches_raw, lambda df: R_.normalize_matches(df, S.MATCHES, keep=(S.MATCHES_KEY,)), [*S.MATCHES.longs, *S.MATCHES.ints, *S.MATCHES.doubles]),
    ):
        account = RowAccount(name)
        rows = account.mark(normalize(account.mark(raw(spark, sf), "read")), "kept")
        release(leased_table(account.mark(rows, "usable", valid(numeric)), "accounted"))
        accounts.append(account)
    return account_frame(spark, accounts)


def q_profile_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of three tables: nulls, range and values of at least 1 % of the
    rows, and whether the distinct count lies within four times its stated error."""
    out = []
    for name, empty in (("lineitem", {"l_returnflag": "N"}), ("orders", {"o_orderstatus": "P"}), ("part", {"p_size": 7})):
        df = S.table(spark, sf, name).withColumns({c: F.nullif(F.col(c), F.lit(v)) for c, v in empty.items()})
        exact = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns])
        exact = exact.unpivot([], df.columns, "column", "distinct")
        close = F.abs(F.col("distinct_estimate") - F.col("distinct")) <= 4 * DISTINCT_ERROR * F.col("distinct")
        heavy = F.array_join(F.transform("heavy", lambda h: F.concat_ws(":", h["value"], h["n"].cast("string"))), ",")
        out.append(
            wide_profile(df).join(exact, "column").select(
                F.lit(name).alias("dataset"), "column", "rows", "nulls", "min_value", "max_value", close.alias("distinct_within_error"), heavy.alias("heavy")
            )
        )
    return functools.reduce(DataFrame.unionByName, out)


def q_tercile_target(spark: SparkSession, sf: str) -> DataFrame:
    """Exact cut points and the rows per bin (bins from the raw column: no join)."""
    raw = R.dropna_subset(C.cast_double(S.salary_raw(spark, sf), ["salary"]), ["salary"])
    q1, q2 = exact_quantiles(raw, "salary", [1 / 3, 2 / 3])
    binned = raw.withColumn(S.SALARY.target, bin_by_cut_points("salary", [q1, q2], TERCILE_LABELS))
    return binned.groupBy(S.SALARY.target).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("salary").alias("min_salary"),
        F.max("salary").alias("max_salary"),
        F.lit(q1).alias("q1"),
        F.lit(q2).alias("q2"),
    )


QUANTILE_PROBS = (0.01, 0.25, 1 / 3, 0.5, 2 / 3, 0.75, 0.99)


def q_quantiles_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Exact percentile_disc of a near-unique column of the whole lineitem table
    (more distinct values than the collect bound, so the narrowing path runs)."""
    li = S.table(spark, sf, "lineitem")
    vals = exact_quantiles(li, "l_extendedprice", QUANTILE_PROBS, max_collect=20_000)
    return spark.createDataFrame(
        [(i, float(p), float(v)) for i, (p, v) in enumerate(zip(QUANTILE_PROBS, vals))],
        "i int, p double, q double",
    )


def q_schema_report(spark: SparkSession, sf: str) -> DataFrame:
    """Schema of every normalised stand-in (from the analysed plans, no job)."""
    out = None
    for name, (fn, target) in RECIPES.items():
        sch = schema_frame(spark, fn(spark, sf), target).select(
            F.lit(name).alias("dataset"), "position", "column", "data_type", "is_target"
        )
        out = sch if out is None else out.unionByName(sch)
    return out


def q_label_index(spark: SparkSession, sf: str) -> DataFrame:
    rec = S.recipe_salary(spark, sf)
    vocab = fit_vocabularies(rec, [S.SALARY.target])
    return label_indexer(vocab[S.SALARY.target], S.SALARY.target).transform(rec).select(
        S.SALARY_KEY, S.SALARY.target, "label"
    )


def q_category_index(spark: SparkSession, sf: str) -> DataFrame:
    rec = S.recipe_salary(spark, sf)
    cats = list(S.SALARY.categorical)
    out = index_columns(rec, fit_vocabulary_table(rec, cats), cats)
    return out.select(S.SALARY_KEY, *[f"{c}_idx" for c in cats])


def q_category_index_large(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of very many categories: every order and part of ``lineitem``."""
    li = S.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    cats = ["l_orderkey", "l_partkey"]
    out = index_columns(li, fit_vocabulary_table(li, cats), cats)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_orderkey_idx", "l_partkey_idx")


def _salary_features(spark: SparkSession, sf: str):
    rec = hash_split(S.recipe_salary(spark, sf), [S.SALARY_KEY])
    return build_features(rec, S.SALARY.target, exclude=[S.SALARY_KEY, "split"])


def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    feats, _ = _salary_features(spark, sf)
    out = feats.select(S.SALARY_KEY, *[f"{c}_ohe" for c in S.SALARY.categorical])
    for c in S.SALARY.categorical:
        out = with_feature_array(out, f"{c}_ohe")
    return out


def q_build_features(spark: SparkSession, sf: str) -> DataFrame:
    feats, _ = _salary_features(spark, sf)
    return with_feature_array(feats.select(S.SALARY_KEY, "label", FEATURES_COL, "split"))


# ------------------------------------------------------------ splits
def q_random_split(spark: SparkSession, sf: str) -> DataFrame:
    """Every key with the number of sides it is on, and whether the train side
    has about its share."""
    part = S.table(spark, sf, "part").select("p_partkey")
    train, test = random_split(part)
    both = train.select("p_partkey", F.lit(1).alias("t")).unionByName(test.select("p_partkey", F.lit(0).alias("t")))
    share = both.agg(F.avg("t")).first()[0]
    return both.groupBy("p_partkey").agg(F.count("*").alias("sides")).withColumn("share_ok", F.lit(abs(share - 0.8) < 0.05))


def q_hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return hash_split(S.table(spark, sf, "part").select("p_partkey"), ["p_partkey"])


def q_stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    rec = S.recipe_social(spark, sf).select(S.SOCIAL_KEY, S.SOCIAL.target)
    return stratified_split(rec, [S.SOCIAL_KEY], S.SOCIAL.target)


# ------------------------------------------------------- models
def _salary_train_test(spark: SparkSession, sf: str):
    rec = spread_rows(hash_split(S.recipe_salary(spark, sf), [S.SALARY_KEY]))
    feats, _ = build_features(rec, S.SALARY.target, exclude=[S.SALARY_KEY, "split"])
    table = feats.select(S.SALARY_KEY, "label", FEATURES_COL, "split")
    return split_frames(table)


def _predictions(spark: SparkSession, sf: str, estimator) -> DataFrame:
    train, test = _salary_train_test(spark, sf)
    model = estimator.fit(train)
    return model.transform(test).select(S.SALARY_KEY, "label", "prediction")


def _checked(spark: SparkSession, sf: str, estimator) -> DataFrame:
    """Test rows with their label, whether the prediction is one of the classes,
    and whether the model beats always predicting the largest class."""
    pred = _predictions(spark, sf, estimator).persist()
    share = [r["n"] for r in pred.groupBy("label").agg(F.count("*").alias("n")).collect()]
    good = evaluate(pred).accuracy > max(share) / sum(share)
    classes = [float(i) for i in range(3)]
    return pred.select(S.SALARY_KEY, "label", F.col("prediction").isin(classes).alias("in_classes"), F.lit(good).alias("beats_majority"))


def q_train_random_forest(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(spark, sf, random_forest())


def q_train_decision_tree(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(spark, sf, decision_tree())


def q_train_any_estimator(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(spark, sf, logistic_regression(max_iter=20))


def q_predict_naive_bayes(spark: SparkSession, sf: str) -> DataFrame:
    return _predictions(spark, sf, naive_bayes())


def q_train_naive_bayes(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _salary_train_test(spark, sf)
    m = naive_bayes().fit(train)
    pi = m.pi.toArray()
    theta, sigma = m.theta.toArray(), m.sigma.toArray()
    rows = [
        (float(c), j, float(pi[c]), float(theta[c, j]), float(sigma[c, j]))
        for c in range(theta.shape[0])
        for j in range(theta.shape[1])
    ]
    df = spark.createDataFrame(rows, "class double, feature int, pi double, theta double, sigma double")
    return df.select("class", "feature", _r("pi"), _r("theta"), _r("sigma"))


def q_confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return confusion_matrix(q_predict_naive_bayes(spark, sf))


def q_per_class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    pc = per_class_metrics(confusion_matrix(q_predict_naive_bayes(spark, sf)))
    return pc.select("class", "support", "predicted", "tp", _r("precision"), _r("recall"), _r("f1"))


def _nb_scores(spark: SparkSession, sf: str):
    return evaluate(q_predict_naive_bayes(spark, sf))


def q_eval_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    s = _nb_scores(spark, sf)
    return spark.createDataFrame([(round(s.accuracy, DIGITS),)], "accuracy double")


def q_eval_weighted_f1(spark: SparkSession, sf: str) -> DataFrame:
    s = evaluate(q_predict_naive_bayes(spark, sf), method="mllib")
    return spark.createDataFrame([(round(s.weighted_f1, DIGITS),)], "weighted_f1 double")


def q_eval_many_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Scores over a class for every part: the rows of ``lineitem`` predict their part,
    wrongly where the line number is 3 or more."""
    li = S.table(spark, sf, "lineitem")
    preds = li.select(
        F.col("l_partkey").cast("double").alias("label"),
        F.when(F.col("l_linenumber") < 3, F.col("l_partkey")).otherwise(F.col("l_suppkey") * 7).cast("double").alias("prediction"),
    )
    return class_scores(class_counts(preds)).select(_r("accuracy"), _r("weighted_f1"), "n", "classes")


def q_train_and_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    from tabclass.plans.training import train_and_evaluate

    train, test = _salary_train_test(spark, sf)
    res = train_and_evaluate(train, test, naive_bayes())
    return spark.createDataFrame(
        [(round(res.scores.accuracy, DIGITS), round(res.scores.weighted_f1, DIGITS), res.scores.rows)],
        "accuracy double, f1 double, n bigint",
    )


# ---------------------------------------------------- experiments
QUALITY_COLS = ["dataset", "classifier", "workers", "partitions"]


def _quality(df: DataFrame) -> DataFrame:
    return df.select(*QUALITY_COLS, _r("accuracy"), _r("f1"), "status")


def _nb_only() -> ClassifierRegistry:
    return ClassifierRegistry({"naive_bayes": naive_bayes})


def q_run_experiments_nb(spark: SparkSession, sf: str) -> DataFrame:
    rows = run_experiments(spark, S.all_experiments(sf), _nb_only(), config=RunConfig())
    return _quality(metrics_frame(spark, rows))


def q_run_experiments(spark: SparkSession, sf: str) -> DataFrame:
    """All three models on one dataset: what must hold of every metrics row."""
    rows = run_experiments(spark, [S.salary_experiment(sf)], default_classifiers(), config=RunConfig())
    df = metrics_frame(spark, rows)
    times = F.abs(F.col("total_time_s") - F.col("train_time_s") - F.col("predict_time_s")) < 1e-6
    return df.select(
        *QUALITY_COLS, "status", F.col("accuracy").between(0.34, 1.0).alias("accuracy_ok"), F.col("f1").between(0.0, 1.0).alias("f1_ok"),
        (times & (F.col("train_time_s") > 0)).alias("times_ok"),
    )


def q_run_experiments_together(spark: SparkSession, sf: str) -> DataFrame:
    """Fits of one dataset side by side: the same rows as one after the other."""
    registry = ClassifierRegistry({"naive_bayes": naive_bayes, "decision_tree": decision_tree, "naive_bayes_again": naive_bayes})
    together = run_experiments(spark, [S.salary_experiment(sf)], registry, config=RunConfig(side_by_side=3))
    serial = run_experiments(spark, [S.salary_experiment(sf)], registry, config=RunConfig())
    keys = ["dataset", "classifier", "workers", "partitions"]
    both = metrics_frame(spark, together).join(metrics_frame(spark, serial).select(*keys, F.col("accuracy").alias("a"), F.col("f1").alias("f")), keys)
    return both.select(*keys, "status", ((F.abs(F.col("accuracy") - F.col("a")) < 1e-9) & (F.abs(F.col("f1") - F.col("f")) < 1e-9)).alias("as_serial"))


def q_experiment_grid(spark: SparkSession, sf: str) -> DataFrame:
    from tabclass.plans.experiments import experiment_grid

    grid = spark.createDataFrame(
        experiment_grid(list(RECIPES), default_classifiers().names()), "dataset string, classifier string"
    )
    sizes = None
    for name, (fn, _t) in RECIPES.items():
        n = fn(spark, sf).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
        sizes = n if sizes is None else sizes.unionByName(n)
    return grid.join(sizes, "dataset")


def _event_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics rows made of the whole events table: the type is the dataset,
    users the classifier, event ids the run (1, 4 or 8 partitions; the base of
    one classifier is missing), and every 7th user's run failed."""
    ev = S.table(spark, sf, "events")
    clf = F.element_at(F.array(F.lit("random_forest"), F.lit("decision_tree"), F.lit("naive_bayes")), (F.col("user_id") % 3 + 1).cast("int"))
    run = F.element_at(F.array(F.lit(1), F.lit(4), F.lit(8)), (F.col("event_id") % 3 + 1).cast("int"))
    rows = ev.select(
        F.col("event_type").alias("dataset"), clf.alias("classifier"), F.lit(1).alias("workers"), run.alias("partitions"),
        F.when(F.col("user_id") % 7 == 0, "error").otherwise("ok").alias("status"), "value",
    ).where("NOT (classifier = 'naive_bayes' AND dataset = 'view' AND partitions = 1)")
    return rows.groupBy("dataset", "classifier", "workers", "partitions", "status").agg(
        F.round(F.sum("value"), 3).alias("train_time_s"), (F.count("*") / 8).alias("predict_time_s"), F.lit(0.5).alias("accuracy")
    )


def q_results_table(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics rows written by a sink run and read back."""
    path = scratch_path(spark, "results")
    rows = total_time(_event_runs(spark, sf)).withColumn("f1", F.lit(None).cast("double")).withColumn("error", F.lit(None).cast("string"))
    sink = MetricsSink(spark, path, "parquet")
    sink.start()
    rows.select(*metrics_frame(spark, []).columns).write.mode("append").parquet(path)
    return sink.read().select("dataset", "classifier", "workers", "partitions", "status", "accuracy", _r("total_time_s"))


def q_metrics_total_time(spark: SparkSession, sf: str) -> DataFrame:
    return total_time(_event_runs(spark, sf)).select("dataset", "classifier", "partitions", "status", _r("total_time_s"))


def q_time_by_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return time_by_classifier(total_time(_event_runs(spark, sf))).select("classifier", _r("total_time_s"), "experiments")


def _sink_run(spark: SparkSession, sf: str, path: str, partitions: int | None, experiments) -> None:
    cfg = RunConfig(partitions=partitions, sink=MetricsSink(spark, path, "csv"))
    run_experiments(spark, experiments, _nb_only(), config=cfg)


def q_metrics_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    _sink_run(spark, sf, path, None, [S.salary_experiment(sf), S.social_experiment(sf)])
    return _quality(read_metrics(spark, path, "csv"))


def q_results_union(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "runs")
    for p in (2, 4):
        _sink_run(spark, sf, run_folder(base, 1, p), p, [S.salary_experiment(sf)])
    return _quality(read_metrics(spark, f"{base}/experiments_w*", "csv"))


def q_sweep_speedup(spark: SparkSession, sf: str) -> DataFrame:
    found = sweep_speedup(total_time(_event_runs(spark, sf)))
    return found.select("dataset", "classifier", "workers", "partitions", _r("total_time_s"), _r("base_time_s"), _r("speedup"))


def q_sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sample_rows(S.recipe_social(spark, sf), [S.SOCIAL_KEY], 5)


# --------------------------------------------------------------- recipes (D)
def q_recipe_social(spark: SparkSession, sf: str) -> DataFrame:
    return S.recipe_social(spark, sf)


def q_recipe_fraud(spark: SparkSession, sf: str) -> DataFrame:
    df = S.recipe_fraud(spark, sf)
    return df.withColumn("distance_to_merchant", F.round("distance_to_merchant", DIGITS))


def q_recipe_matches(spark: SparkSession, sf: str) -> DataFrame:
    return S.recipe_matches(spark, sf)


def q_recipe_salary(spark: SparkSession, sf: str) -> DataFrame:
    return S.recipe_salary(spark, sf)


QUERIES = {
    # sources / sinks / partitioning
    "scan_csv": q_scan_csv,
    "scan_csv_records": q_scan_csv_records,
    "dataset_catalog": q_dataset_catalog,
    "repartition_rows": q_repartition_rows,
    "metrics_sink": q_metrics_sink,
    "results_union": q_results_union,
    # columns
    "drop_columns": q_drop_columns,
    "cast_int": q_cast_int,
    "cast_long": q_cast_long,
    "cast_double": q_cast_double,
    "trim_categoricals": q_trim_categoricals,
    "select_contract": q_select_contract,
    "rename_snake_case": q_rename_snake_case,
    "infer_column_roles": q_infer_column_roles,
    # rows
    "dropna_subset": q_dropna_subset,
    "dropna_any": q_dropna_any,
    "filter_allowed": q_filter_allowed,
    "impute_target_default": q_impute_target_default,
    "skip_invalid_rows": q_skip_invalid_rows,
    # scalars
    "parse_timestamp": q_parse_timestamp,
    "calendar_features": q_calendar_features,
    "year_diff": q_year_diff,
    "haversine_km": q_haversine_km,
    # statistics
    "profile_table": q_profile_table,
    "quantiles_approx": q_quantiles_approx,
    "tercile_target": q_tercile_target,
    "quantiles_exact": q_quantiles_exact,
    "sample_rows": q_sample_rows,
    "schema_report": q_schema_report,
    # features
    "label_index": q_label_index,
    "category_index": q_category_index,
    "category_index_large": q_category_index_large,
    "quantiles_sketch": q_quantiles_sketch,
    "row_accounting": q_row_accounting,
    "profile_wide": q_profile_wide,
    "one_hot": q_one_hot,
    "assemble_features": q_assemble_features,
    "build_features": q_build_features,
    # splits
    "random_split": q_random_split,
    "hash_split": q_hash_split,
    "stratified_split": q_stratified_split,
    # models and metrics
    "train_random_forest": q_train_random_forest,
    "train_decision_tree": q_train_decision_tree,
    "train_naive_bayes": q_train_naive_bayes,
    "predict_naive_bayes": q_predict_naive_bayes,
    "train_any_estimator": q_train_any_estimator,
    "confusion_matrix": q_confusion_matrix,
    "per_class_metrics": q_per_class_metrics,
    "eval_accuracy": q_eval_accuracy,
    "eval_many_classes": q_eval_many_classes,
    "eval_weighted_f1": q_eval_weighted_f1,
    "train_and_evaluate": q_train_and_evaluate,
    # experiments and results
    "experiment_grid": q_experiment_grid,
    "run_experiments": q_run_experiments,
    "run_experiments_together": q_run_experiments_together,
    "run_experiments_nb": q_run_experiments_nb,
    "results_table": q_results_table,
    "metrics_total_time": q_metrics_total_time,
    "time_by_classifier": q_time_by_classifier,
    "sweep_speedup": q_sweep_speedup,
    # recipes
    "recipe_social": q_recipe_social,
    "recipe_fraud": q_recipe_fraud,
    "recipe_matches": q_recipe_matches,
    "recipe_salary": q_recipe_salary,
}
