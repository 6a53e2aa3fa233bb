"""Stand-in datasets built from the driver's TPC-H-like tables.

The reference's four CSVs are not available, so each recipe is exercised on a
driver table shaped like its raw input (text columns where the CSV would give
text, injected NULLs and bad values by a fixed rule on the row key).  The same
shaping is written in SQL for the DuckDB checks.  All of it reads the whole
table; nothing is sampled or capped.

The key rules (``key % 17 = 0`` -> NULL and so on) only REPLACE values: the
driver tables have no NULLs, and the recipes exist to handle them.  No rule
selects rows; rows disappear only through a recipe's own null or
allowed-value rule, exactly as they would on real input.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabclass.plans import recipes
from tabclass.plans.experiments import ExperimentDataset

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _nth(key: str, m: int):
    return (F.col(key) % m) == 0


# -------------------------------------------------------------- salary / part
SALARY = recipes.SalaryColumns(
    numeric_int=("p_partmod", "p_size"),
    categorical=("p_type", "p_brand"),
    source="salary",
    target="price_tercile",
    quantile_method="exact",
)
SALARY_KEY = "p_partkey"


def salary_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> salary-shaped rows: NULL price every 17th key, padded type every 7th."""
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        (F.col("p_partkey") % 1000).alias("p_partmod"),
        "p_size",
        F.when(_nth("p_partkey", 7), F.concat(F.lit(" "), F.col("p_type"))).otherwise(F.col("p_type")).alias("p_type"),
        "p_brand",
        F.when(_nth("p_partkey", 17), F.lit(None)).otherwise(F.col("p_retailprice")).alias("salary"),
    )


def recipe_salary(spark: SparkSession, sf_dir: str, method: str = "exact", fit_filter=None) -> DataFrame:
    cols = SALARY if method == "exact" else recipes.SalaryColumns(**{**SALARY.__dict__, "quantile_method": method})
    return recipes.normalize_salary(salary_raw(spark, sf_dir), cols, keep=(SALARY_KEY,), fit_filter=fit_filter)


# ------------------------------------------------------------- social / orders
SOCIAL = recipes.SocialColumns(
    numeric_int=("o_custkey",),
    numeric_double=("o_totalprice",),
    categorical=("o_orderpriority",),
    target="o_orderstatus",
    allowed=("F", "O", "P"),
)
SOCIAL_KEY = "o_orderkey"


def social_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as CSV-like text: bad customer text every 19th key, NULL status every
    17th, unknown status 'X' every 23rd, padded priority every 5th."""
    o = table(spark, sf_dir, "orders")
    k = "o_orderkey"
    return o.select(
        k,
        F.when(_nth(k, 19), F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.when(_nth(k, 5), F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(_nth(k, 17), F.lit(None)).when(_nth(k, 23), F.lit("X")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
    )


def recipe_social(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.normalize_social(social_raw(spark, sf_dir), SOCIAL, keep=(SOCIAL_KEY,))


# -------------------------------------------------------------- fraud / events
FRAUD_KEY = "event_id"


def fraud_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> card-transaction-shaped rows.

    Coordinates come from the ids: customer lat = id*37 % 180 - 90, lon =
    id*53 % 360 - 180; merchant n = user_id % 25 at lat n*7 - 80, lon n*14 - 170.
    Birth year 1950 + user_id % 50.  NULL amount every 17th event, bad time
    text every 29th, NULL state every 31st.
    """
    e = table(spark, sf_dir, "events")
    k, u = F.col("event_id"), F.col("user_id")
    n = u % 25
    return e.select(
        "event_id",
        F.when(_nth("event_id", 29), F.lit("not a time")).otherwise(F.col("ts").cast("string")).alias("trans_date_trans_time"),
        F.concat((F.lit(1950) + u % 50).cast("string"), F.lit("-06-15")).alias("dob"),
        ((k * 37) % 180 - 90).cast("double").alias("lat"),
        ((k * 53) % 360 - 180).cast("double").alias("long"),
        (n * 7 - 80).cast("double").alias("merch_lat"),
        (n * 14 - 170).cast("double").alias("merch_long"),
        F.when(_nth("event_id", 17), F.lit(None)).otherwise(F.col("value")).alias("amt"),
        (u % 5).cast("string").alias("category"),
        F.when(u % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.when(_nth("event_id", 31), F.lit(None)).otherwise(F.concat(F.lit("S"), (u % 7).cast("string"))).alias("state"),
        (u * 1000).alias("city_pop"),
        F.concat(F.lit("J"), (u % 11).cast("string")).alias("job"),
        F.when(F.col("event_type") == "purchase", F.lit(1)).otherwise(F.lit(0)).alias("is_fraud"),
    )


def recipe_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.normalize_fraud(fraud_raw(spark, sf_dir), keep=(FRAUD_KEY,))


# ---------------------------------------------------------- matches / lineitem
MATCHES = recipes.MatchesColumns(
    drop=("l_suppkey", "l_shipdate", "l_linestatus", "game_id"),
    strings=("l_returnflag",),
    longs=("l_partkey",),
    ints=("l_linenumber",),
    doubles=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    target="win",
)
MATCHES_KEY = "l_orderkey"


def matches_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with text ids and a 'win' target: status F -> '1' (padded every
    4th order), otherwise by l_partkey % 4: NULL, 'NULL', '' or 'True'."""
    li = table(spark, sf_dir, "lineitem")
    pk = F.col("l_partkey") % 4
    other = (
        F.when(pk == 0, F.lit(None).cast("string"))
        .when(pk == 1, F.lit("NULL"))
        .when(pk == 2, F.lit(""))
        .otherwise(F.lit("True"))
    )
    win = F.when(
        F.col("l_linestatus") == "F",
        F.when(_nth("l_orderkey", 4), F.lit(" 1 ")).otherwise(F.lit("1")),
    ).otherwise(other)
    return li.select(
        "l_orderkey",
        F.col("l_partkey").cast("string").alias("l_partkey"),
        "l_suppkey",
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
        win.alias("win"),
    )


def recipe_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.normalize_matches(matches_raw(spark, sf_dir), MATCHES, keep=(MATCHES_KEY,))


# ------------------------------------------------------------ experiment sets
def salary_experiment(sf_dir: str) -> ExperimentDataset:
    return ExperimentDataset(
        name="part_salary",
        load=lambda spark: recipe_salary(spark, sf_dir),
        target=SALARY.target,
        keys=(SALARY_KEY,),
        size_category="medium",
        load_fitted_on=lambda spark, cond: recipe_salary(spark, sf_dir, fit_filter=cond),
    )


def social_experiment(sf_dir: str) -> ExperimentDataset:
    return ExperimentDataset(
        name="orders_social",
        load=lambda spark: recipe_social(spark, sf_dir),
        target=SOCIAL.target,
        keys=(SOCIAL_KEY,),
    )


def fraud_experiment(sf_dir: str) -> ExperimentDataset:
    return ExperimentDataset(
        name="events_fraud",
        load=lambda spark: recipe_fraud(spark, sf_dir),
        target="is_fraud",
        keys=(FRAUD_KEY,),
        size_category="large",
    )


def matches_experiment(sf_dir: str) -> ExperimentDataset:
    # l_orderkey alone is not unique; the hash key is the unique column set.
    return ExperimentDataset(
        name="lineitem_matches",
        load=lambda spark: recipes.normalize_matches(
            matches_raw(spark, sf_dir).withColumn("l_row", F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")),
            MATCHES,
            keep=("l_row",),
        ),
        target="win",
        keys=("l_row",),
        numeric=None,
        categorical=None,
        size_category="large",
    )


def all_experiments(sf_dir: str) -> list[ExperimentDataset]:
    return [social_experiment(sf_dir), fraud_experiment(sf_dir), matches_experiment(sf_dir), salary_experiment(sf_dir)]
