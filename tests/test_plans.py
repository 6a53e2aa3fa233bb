"""Guards on the physical plans that the scale design relies on."""
from tabclass.operators.evaluate import confusion_matrix
from tabclass.operators.features import _stacked_counts, build_features
from tabclass.operators.split import hash_split, stratified_split
from tabclass.plans import standins as S

from conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_recipes_and_hash_split_do_not_shuffle(spark):
    for df in (S.recipe_social(spark, SF001), S.recipe_fraud(spark, SF001), hash_split(S.recipe_social(spark, SF001), "o_orderkey")):
        plan = _plan(df)
        assert "Exchange" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_scan_reads_only_used_columns(spark):
    plan = _plan(S.recipe_social(spark, SF001))
    assert "o_orderdate" not in plan  # the unused column never reaches the reader
    feats = build_features(S.recipe_matches(spark, SF001), "win", exclude=["l_orderkey"])[0].select("features")
    fplan = _plan(feats)
    assert "l_suppkey" not in fplan and "l_shipdate" not in fplan and "Exchange" not in fplan


def test_aggregations_combine_map_side(spark):
    for df in (
        _stacked_counts(S.recipe_social(spark, SF001), ["o_orderpriority", "o_orderstatus"]),
        confusion_matrix(S.recipe_social(spark, SF001).selectExpr("1.0 as label", "2.0 as prediction")),
    ):
        plan = _plan(df)
        assert "partial_count" in plan and plan.count("Exchange") == 1


def test_stratified_final_pass_is_a_broadcast_join(spark):
    df = stratified_split(S.recipe_social(spark, SF001).select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus")
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Window" not in plan
