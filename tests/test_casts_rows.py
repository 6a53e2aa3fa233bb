
from pyspark.sql import functions as F

from tabclass.functions import safe_double, safe_int, safe_long, trimmed_string
from tabclass.operators import columns as C
from tabclass.operators import rows as R


def test_safe_casts_on_text(spark):
    df = spark.createDataFrame(
        [("3.9",), ("NULL",), ("",), (" 7 ",), ("2147483648",), ("-2.5",), ("9007199254740993",), ("abc",), (None,)],
        "x string",
    )
    out = df.select(
        safe_int("x", df.schema["x"].dataType).alias("i"),
        safe_long("x", df.schema["x"].dataType).alias("l"),
        safe_double("x").alias("d"),
    ).collect()
    assert [r.i for r in out] == [3, None, None, 7, None, -2, None, None, None]
    assert out[6].l == 9007199254740993  # no precision lost through double
    assert out[0].l == 3 and out[5].l == -2
    assert out[0].d == 3.9 and out[1].d is None


def test_safe_int_from_double_truncates_and_nan_is_null(spark):
    df = spark.createDataFrame([(3.9,), (-3.9,), (float("nan"),), (1e12,)], "x double")
    got = [r[0] for r in df.select(safe_int("x", df.schema["x"].dataType)).collect()]
    assert got == [3, -3, None, None]


def test_trim_only_spaces(spark):
    df = spark.createDataFrame([("  a b  ",), ("\tx\n",)], "s string")
    got = [r[0] for r in df.select(trimmed_string("s")).collect()]
    assert got == ["a b", "\tx\n"]


def test_cast_columns_keeps_order_and_names(spark):
    df = spark.createDataFrame([("1", " a ", "2.5")], "n string, c string, d string")
    out = C.cast_columns(df, {"n": "int", "c": "string", "d": "double"})
    assert out.columns == ["n", "c", "d"]
    assert out.first().asDict() == {"n": 1, "c": "a", "d": 2.5}


def test_select_contract_missing_column_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    try:
        C.select_contract(df, [("a", "int"), ("b", "string")])
    except ValueError as e:
        assert "b" in str(e)
    else:
        raise AssertionError("expected ValueError")


def test_drop_ignores_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.drop_columns(df, ["b", "nope"]).columns == ["a"]


def test_rename_snake_case_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, ` c ` int")
    assert C.rename_snake_case(df).columns == ["a_b", "c"]
    clash = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    try:
        C.rename_snake_case(clash)
    except ValueError:
        pass
    else:
        raise AssertionError("expected collision error")


def test_infer_roles(spark):
    df = spark.createDataFrame(
        [(1, 2.0, "x", True, "y")], "i int, d double, s string, b boolean, t string"
    ).withColumn("ts", F.current_timestamp())
    roles = C.infer_column_roles(df.schema, "t")
    assert roles.numeric == ["i", "d"] and roles.categorical == ["s"] and roles.ignored == ["b", "ts"]
    override = C.infer_column_roles(df.schema, "t", numeric=["d"], categorical=["s"])
    assert override.numeric == ["d"] and set(override.ignored) == {"i", "b", "ts"}


def test_dropna_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, y string")
    assert R.dropna_subset(df, ["x"]).count() == 2
    assert R.dropna_any(df).count() == 1


def test_filter_allowed_rejects_null(spark):
    df = spark.createDataFrame([("Low",), (None,), ("X",), ("High",)], "t string")
    assert sorted(r.t for r in R.filter_allowed(df, "t", ["Low", "Medium", "High"]).collect()) == ["High", "Low"]
    rep = {r.value: (r.n, r.kept) for r in R.allowed_value_report(df, "t", ["Low"]).collect()}
    assert rep[None] == (1, False) and rep["Low"] == (1, True)


def test_impute_target_default_and_drop_policy(spark):
    df = spark.createDataFrame([("1",), (None,), ("NULL",), ("",), ("0",), ("True",)], "w string")
    assert [r.w for r in R.impute_target_default(df, "w").collect()] == ["1", "0", "0", "0", "0", "True"]
    assert R.impute_target_default(df, "w", policy="drop").count() == 3
    mapped = R.map_boolean_text(spark.createDataFrame([("True",), ("false",), ("1",)], "w string"), "w")
    assert [r.w for r in mapped.collect()] == ["1", "0", "1"]
