"""Print the physical plans of the main operators (``explain("formatted")``).

Usage: python tools/show_plans.py [sf_dir] [name ...]
"""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabclass.operators.evaluate import confusion_matrix  # noqa: E402
from tabclass.operators.features import _stacked_counts, build_features, with_feature_array  # noqa: E402
from tabclass.operators.split import hash_split, stratified_split  # noqa: E402
from tabclass.plans import standins as S  # noqa: E402
from tools.local_spark import one_machine  # noqa: E402


def plans(spark, sf):
    return {
        "recipe_social": lambda: S.recipe_social(spark, sf),
        "recipe_fraud": lambda: S.recipe_fraud(spark, sf),
        "vocabulary_counts": lambda: _stacked_counts(S.recipe_social(spark, sf), ["o_orderpriority", "o_orderstatus"]),
        "feature_transform": lambda: with_feature_array(
            build_features(S.recipe_matches(spark, sf), "win", exclude=[S.MATCHES_KEY])[0].select("label", "features")
        ),
        "hash_split": lambda: hash_split(S.recipe_social(spark, sf), ["o_orderkey"]),
        "stratified_split_final": lambda: stratified_split(
            S.recipe_social(spark, sf).select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus"
        ),
        "confusion_matrix": lambda: confusion_matrix(
            S.recipe_social(spark, sf).selectExpr("cast(o_custkey % 3 as double) as label", "cast(o_orderkey % 3 as double) as prediction")
        ),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = one_machine()
    for name, build in plans(spark, sf).items():
        if only and name not in only:
            continue
        print(f"\n######## {name}")
        build().explain("formatted")


if __name__ == "__main__":
    main()
