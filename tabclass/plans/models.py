"""Classifier registry: name -> zero-argument factory of an MLlib estimator."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)

from tabclass.operators.features import FEATURES_COL, LABEL_COL
from tabclass.operators.split import DEFAULT_SEED


# Fixed values that must equal the reference: forest 100 trees of depth 10,
# tree depth 10, seed 42, Gaussian naive Bayes.
#
# ``cache_node_ids`` / ``checkpoint_interval`` / ``max_memory_mb`` do not
# change the model, only how MLlib trains it: for deep trees over very large
# inputs, caching node ids (checkpointed to the shared checkpoint folder every
# ``checkpoint_interval`` iterations) avoids re-walking the trees for every
# row at each level, and more memory lets more nodes split per pass.
def random_forest(
    num_trees: int = 100,
    max_depth: int = 10,
    seed: int = DEFAULT_SEED,
    cache_node_ids: bool = False,
    checkpoint_interval: int = 10,
    max_memory_mb: int = 256,
) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=FEATURES_COL, labelCol=LABEL_COL, numTrees=num_trees, maxDepth=max_depth, seed=seed,
        cacheNodeIds=cache_node_ids, checkpointInterval=checkpoint_interval, maxMemoryInMB=max_memory_mb,
    )


def decision_tree(
    max_depth: int = 10,
    seed: int = DEFAULT_SEED,
    cache_node_ids: bool = False,
    checkpoint_interval: int = 10,
    max_memory_mb: int = 256,
) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        featuresCol=FEATURES_COL, labelCol=LABEL_COL, maxDepth=max_depth, seed=seed,
        cacheNodeIds=cache_node_ids, checkpointInterval=checkpoint_interval, maxMemoryInMB=max_memory_mb,
    )


def naive_bayes() -> NaiveBayes:
    """Gaussian NB: accepts any real feature (raw numerics and one-hots).

    MLlib floors every variance at 1e-9 times the largest feature variance;
    with unscaled features that floor can dominate small-scale features.
    """
    return NaiveBayes(featuresCol=FEATURES_COL, labelCol=LABEL_COL, modelType="gaussian")


def logistic_regression(max_iter: int = 20) -> LogisticRegression:
    return LogisticRegression(featuresCol=FEATURES_COL, labelCol=LABEL_COL, maxIter=max_iter)


class ClassifierRegistry:
    def __init__(self, factories: dict[str, Callable[[], object]] | None = None):
        self._f: dict[str, Callable[[], object]] = dict(factories or {})

    def register(self, name: str, factory: Callable[[], object]) -> None:
        self._f[name] = factory

    def create(self, name: str):
        if name not in self._f:
            raise ValueError(f"unknown classifier {name!r}; available: {sorted(self._f)}")
        return self._f[name]()

    def select(self, name: str | None = None) -> list[str]:
        if name is None:
            return list(self._f)
        if name not in self._f:
            raise ValueError(f"unknown classifier {name!r}; available: {sorted(self._f)}")
        return [name]

    def names(self) -> list[str]:
        return list(self._f)


def default_classifiers() -> ClassifierRegistry:
    """The reference's three, in its order."""
    return ClassifierRegistry(
        {"random_forest": random_forest, "decision_tree": decision_tree, "naive_bayes": naive_bayes}
    )
