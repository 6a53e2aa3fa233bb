import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import StringIndexer

from tabclass.operators.features import (
    TooManyCategories,
    build_features,
    category_counts,
    fit_vocabularies,
)


def _frame(spark):
    rows = [
        ("b", 1.0, "x"), ("a", 2.0, "x"), ("b", 3.0, "y"), ("c", 4.0, "y"), ("a", None, "y"),
        (None, 5.0, "x"), ("a", 6.0, "z"), ("b", float("nan"), "x"), ("c", 7.0, "z"),
    ]
    return spark.createDataFrame(rows, "cat string, num double, target string")


def test_vocabulary_order_matches_string_indexer(spark):
    df = _frame(spark)
    vocab = fit_vocabularies(df, ["cat", "target"])
    for col in ("cat", "target"):
        fitted = StringIndexer(inputCol=col, outputCol="o", handleInvalid="keep").fit(df)
        assert vocab[col] == list(fitted.labels)
    ranked = {(r.column, r.value): r.idx for r in category_counts(df, ["cat"]).collect()}
    assert [v for (_, v), _i in sorted(ranked.items(), key=lambda kv: kv[1])] == vocab["cat"]


def test_max_categories_guard(spark):
    df = spark.createDataFrame([(str(i),) for i in range(50)], "c string")
    with pytest.raises(TooManyCategories):
        fit_vocabularies(df, ["c"], max_categories=10)


def test_pipeline_semantics(spark):
    df = _frame(spark)
    feats, model = build_features(df, "target")
    rows = {tuple(r.features): r for r in feats.select(vector_to_array("features").alias("features"), "cat", "label").collect()}
    # rows with a NULL or NaN numeric are skipped
    assert feats.count() == 7
    # numerics first, then one slot per category; NULL category -> all zeros
    for vec, r in rows.items():
        assert len(vec) == 1 + 3
        if r.cat is None:
            assert vec[1:] == (0.0, 0.0, 0.0)
        else:
            assert sum(vec[1:]) == 1.0 and vec[1 + model.vocabularies["cat"].index(r.cat)] == 1.0
    # label metadata keeps an extra unknown class (K + 1 values)
    meta = feats.schema["label"].metadata["ml_attr"]["vals"]
    assert meta[-1] == "__unknown" and len(meta) == 4


def test_unseen_category_is_all_zero(spark):
    df = _frame(spark)
    _, model = build_features(df.where("cat <> 'c' OR cat IS NULL"), "target")
    out = model.transform(df.where("cat = 'c'")).select(vector_to_array("features").alias("f")).collect()
    assert out and all(sum(r.f[1:]) == 0.0 for r in out)


def test_fit_scope_train_only(spark):
    df = _frame(spark)
    _, model = build_features(df, "target", fit_df=df.where("cat = 'a'"))
    assert model.vocabularies["cat"] == ["a"]


def test_pipeline_save_and_load(spark):
    from pyspark.ml import PipelineModel

    from tabclass.session import scratch_path

    df = _frame(spark)
    feats, model = build_features(df, "target")
    path = scratch_path(spark, "pipeline")
    model.pipeline.save(path)
    again = PipelineModel.load(path).transform(df)
    a = sorted(tuple(r.f) for r in feats.select(vector_to_array("features").alias("f")).collect())
    b = sorted(tuple(r.f) for r in again.select(vector_to_array("features").alias("f")).collect())
    assert a == b
    assert model.feature_names()[0] == "num" and "cat=a" in model.feature_names()


def test_no_feature_columns_is_a_clear_error(spark):
    df = spark.createDataFrame([("a", True)], "target string, flag boolean")
    with pytest.raises(ValueError, match="no numeric or categorical"):
        build_features(df, "target")
