"""Classification metrics.

The reference runs two ``MulticlassClassificationEvaluator`` jobs (accuracy,
weighted F1), each a full pass over the predictions.  ``evaluate`` gets both
from ONE aggregation: the confusion matrix, whose size is classes x classes
whatever the row count.  The formulas are MLlib's ``MulticlassMetrics``:

* accuracy = sum of the diagonal / number of rows;
* weighted F1 = sum over true classes c of (n_c / N) * F1_c, with
  F1_c = 2 P R / (P + R), P = tp / predicted_c, R = tp / n_c, and 0 when
  P + R = 0.  Classes that only occur as predictions add nothing.

With very many classes the cells are as many as the rows.  ``class_counts`` counts
support, predictions and hits per class in one pass without cells, and
``class_scores`` reduces them inside Spark to one row; ``evaluate`` turns to it when
there are more than MAX_CELLS cells.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_matrix(
    preds: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """(label, prediction, n): one row per non-empty cell."""
    return preds.groupBy(
        F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


#: Confusion cells that are brought to the driver, at most.
MAX_CELLS = 250_000


def class_counts(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(class, support, predicted, tp) of every class that occurs, one pass: a row
    counts for its label and for its prediction, before the only shuffle."""
    y, p = F.col(f"`{label}`").cast("double"), F.col(f"`{prediction}`").cast("double")
    part = lambda c, s, q, t: F.struct(c.alias("class"), F.lit(s).alias("s"), F.lit(q).alias("q"), F.lit(t).alias("t"))
    parts = F.when(y.eqNullSafe(p), F.array(part(y, 1, 1, 1))).otherwise(F.array(part(y, 1, 0, 0), part(p, 0, 1, 0)))
    return (
        preds.select(F.explode(parts).alias("c")).groupBy(F.col("c.class").alias("class"))
        .agg(F.sum("c.s").alias("support"), F.sum("c.q").alias("predicted"), F.sum("c.t").alias("tp"))
    )


def class_scores(counts: DataFrame) -> DataFrame:
    """One row (accuracy, weighted_f1, n, classes) of ``class_counts``; NULL scores
    without rows.  F1 is 2 tp / (support + predicted)."""
    f1 = F.lit(2.0) * F.col("tp") / (F.col("support") + F.col("predicted"))
    return counts.agg(
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.try_divide(F.sum(f1 * F.col("support")), F.sum("support")).alias("weighted_f1"),
        F.coalesce(F.sum("support"), F.lit(0)).alias("n"),
        F.count_if(F.col("support") > 0).alias("classes"),
    )


def collected_scores(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> Scores:
    """Scores by the confusion cells, or by class if there are more than MAX_CELLS."""
    found = confusion_matrix(preds, label, prediction).limit(MAX_CELLS + 1).collect()
    if len(found) <= MAX_CELLS:
        return scores_from_confusion([(r["label"], r["prediction"], r["n"]) for r in found])
    del found
    r = class_scores(class_counts(preds, label, prediction)).first()
    return Scores(r["accuracy"], r["weighted_f1"], r["n"])


def per_class_metrics(confusion: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(class, support, predicted, tp, precision, recall, f1) from a confusion table.

    Works on the small confusion table only (classes x classes rows, per
    group of ``by`` columns such as dataset and classifier).
    """
    actual = confusion.groupBy(*by, F.col("label").alias("class")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"),
    )
    predicted = confusion.groupBy(*by, F.col("prediction").alias("class")).agg(F.sum("n").alias("predicted"))
    m = actual.join(predicted, [*by, "class"], "full_outer").fillna(0, ["support", "tp", "predicted"])
    p = F.when(F.col("predicted") > 0, F.col("tp").cast("double") / F.col("predicted")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp").cast("double") / F.col("support")).otherwise(F.lit(0.0))
    m = m.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(
        F.col("precision") + F.col("recall") > 0,
        F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")),
    ).otherwise(F.lit(0.0))
    return m.withColumn("f1", f1)


@dataclass(frozen=True)
class Scores:
    accuracy: float
    weighted_f1: float
    rows: int
    cells: tuple = ()  # (label, prediction, n) confusion cells, when known


def scores_from_confusion(cells: list[tuple[float, float, int]]) -> Scores:
    """Accuracy and weighted F1 from collected (label, prediction, n) cells."""
    total = sum(n for _, _, n in cells)
    if total == 0:
        return Scores(float("nan"), float("nan"), 0, tuple(cells))
    support: dict[float, int] = {}
    predicted: dict[float, int] = {}
    tp: dict[float, int] = {}
    for lab, pred, n in cells:
        support[lab] = support.get(lab, 0) + n
        predicted[pred] = predicted.get(pred, 0) + n
        if lab == pred:
            tp[lab] = tp.get(lab, 0) + n
    acc = sum(tp.values()) / total
    wf1 = 0.0
    for c, n_c in support.items():
        t = tp.get(c, 0)
        p = t / predicted[c] if predicted.get(c, 0) > 0 else 0.0
        r = t / n_c
        f1 = 2.0 * p * r / (p + r) if p + r > 0 else 0.0
        wf1 += f1 * n_c / total
    return Scores(acc, wf1, total, tuple(cells))


def evaluate(
    preds: DataFrame, label: str = "label", prediction: str = "prediction", method: str = "confusion"
) -> Scores:
    """Accuracy and weighted F1; ``confusion`` = one job, with the cells; ``classes`` = one
    job and one row, for any number of classes; ``mllib`` = the reference's two."""
    if method == "confusion":
        return collected_scores(preds, label, prediction)
    if method == "classes":
        r = class_scores(class_counts(preds, label, prediction)).first()
        none = float("nan")
        return Scores(none if r["n"] == 0 else r["accuracy"], none if r["n"] == 0 else r["weighted_f1"], r["n"])
    if method == "mllib":
        ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction)
        acc = ev.setMetricName("accuracy").evaluate(preds)
        f1 = ev.setMetricName("f1").evaluate(preds)
        return Scores(acc, f1, -1)
    raise ValueError(f"unknown evaluation method {method!r}")


def scores_frame(confusion: DataFrame) -> DataFrame:
    """One-row (accuracy, weighted_f1, n) DataFrame computed inside Spark."""
    pc = per_class_metrics(confusion)
    return pc.agg(
        (F.sum("tp").cast("double") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
        F.sum("support").alias("n"),
    )
