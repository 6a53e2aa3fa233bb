"""Fit one estimator, predict, score, time."""
from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tabclass.operators.evaluate import Scores, collected_scores, evaluate


@dataclass
class TrainResult:
    model: object
    scores: Scores
    train_time_s: float
    predict_time_s: float
    predictions: DataFrame | None = None  # cached (label, prediction) when kept

    @property
    def total_time_s(self) -> float:
        return self.train_time_s + self.predict_time_s

    def as_metrics(self) -> dict:
        return {
            "accuracy": self.scores.accuracy,
            "f1": self.scores.weighted_f1,
            "train_time_s": self.train_time_s,
            "predict_time_s": self.predict_time_s,
            "total_time_s": self.total_time_s,
            "confusion": list(self.scores.cells),
        }


def train_and_evaluate(
    train_df: DataFrame,
    test_df: DataFrame,
    estimator,
    eval_method: str = "confusion",
    keep_predictions: bool = False,
) -> TrainResult:
    """Fit on train, predict test, score.

    ``confusion`` (default): predicting every test row and scoring happen in
    ONE aggregation (the confusion matrix of ``transform(test)``), so the
    predictions are never cached and the predict time covers exactly one
    full pass.  ``mllib`` keeps the reference's shape: predictions (label and
    prediction only) are cached and counted, then two evaluator passes run.
    """
    t0 = time.perf_counter()
    model = estimator.fit(train_df)
    train_time = time.perf_counter() - t0

    preds = model.transform(test_df).select("label", "prediction")
    if eval_method == "confusion" and not keep_predictions:
        t0 = time.perf_counter()
        scores = collected_scores(preds)
        predict_time = time.perf_counter() - t0
        return TrainResult(model, scores, train_time, predict_time)

    t0 = time.perf_counter()
    preds.persist(StorageLevel.MEMORY_AND_DISK)
    preds.count()
    predict_time = time.perf_counter() - t0
    try:
        scores = evaluate(preds, method=eval_method)
    finally:
        if not keep_predictions:
            preds.unpersist()
    return TrainResult(model, scores, train_time, predict_time, preds if keep_predictions else None)
