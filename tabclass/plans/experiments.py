"""Experiment runner: every (dataset, classifier) pair -> one metrics row.

The loop is dataset-outer, classifier-inner: load, normalise, feature fit and
split run once per dataset and are shared by its classifiers.  The grid itself
is configuration (names), built on the driver; each step inside it is a Spark
job over the whole dataset.

Differences from the reference, each switchable:

* the cached feature table holds only (label, features, split) and is
  filled before the first fit, so no classifier's train time pays for
  loading and featurising (``materialize``: ``persist`` or ``checkpoint``,
  the latter written to the shared checkpoint folder);
* the split is a persisted column, not a sampler re-run on every use;
* ``split_method="hash"`` gives the same train/test rows at any partition
  count, so a partition sweep compares like with like; ``random`` is the
  reference's ``randomSplit``;
* ``fit_scope="train"`` fits vocabularies on training rows only;
* an unknown dataset or classifier name raises; a failing pair becomes a row
  with ``status="error"`` and the run goes on; with ``resume`` a run that was
  stopped goes on after the last pair it published.
"""
from __future__ import annotations

import itertools
import traceback
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabclass.operators.columns import infer_column_roles
from tabclass.operators.features import FEATURES_COL, LABEL_COL, build_features
from tabclass.operators.partitioning import materialize, repartition_rows, spread_rows
from tabclass.operators.split import (
    DEFAULT_SEED,
    DEFAULT_TRAIN_RATIO,
    SPLIT_COL,
    hash_split,
    hash_split_flag,
    random_split,
    split_frames,
    stratified_split,
)
from tabclass.plans.models import ClassifierRegistry, default_classifiers
from tabclass.plans.training import train_and_evaluate
from tabclass.sources.leases import leases_released, release
from tabclass.sources.metrics_store import MetricsSink, pair_key


@dataclass
class ExperimentDataset:
    """A normalised dataset ready for the feature pipeline."""

    name: str
    load: Callable[[SparkSession], DataFrame]
    target: str
    keys: tuple[str, ...] = ()
    numeric: Sequence[str] | None = None
    categorical: Sequence[str] | None = None
    size_category: str = "medium"
    # Optional: load with a condition marking the rows that statistics of the
    # normalisation itself (e.g. tercile cut points) may be fitted on.
    load_fitted_on: Callable[[SparkSession, Column], DataFrame] | None = None


def dataset_from_spec(spec, root: str | None = None, keys: Sequence[str] = ()) -> ExperimentDataset:
    """Experiment input from a catalog ``DatasetSpec`` (load + normalise).

    Without ``keys`` the hash split keys on the whole normalised row, which is
    what the reference's id-less CSVs need.
    """
    return ExperimentDataset(
        name=spec.name,
        load=lambda s: spec.run(s, root),
        target=spec.target_column,
        keys=tuple(keys),
        size_category=spec.size_category,
    )


@dataclass
class RunConfig:
    workers: int = 1
    partitions: int | None = None
    split_method: str = "hash"
    train_ratio: float = DEFAULT_TRAIN_RATIO
    seed: int = DEFAULT_SEED
    fit_scope: str = "all"
    materialize: str = "persist"
    eval_method: str = "confusion"
    max_categories: int | None = None
    sink: MetricsSink | None = None
    # Fits of one dataset that run at the same time, on its one feature table.  Each has
    # a scheduler pool of its own, which a session with spark.scheduler.mode=FAIR serves
    # in turn; its times then hold what the others took from the cluster.
    side_by_side: int = 1

    def __post_init__(self) -> None:
        if self.side_by_side < 1:
            raise ValueError(f"a run needs one fit at a time or more, not {self.side_by_side}")
        if self.partitions is not None and self.partitions < 1:
            raise ValueError(f"a run needs one partition or more, not {self.partitions}")
        if self.workers < 1:
            raise ValueError(f"a run needs one worker or more, not {self.workers}")
        if self.fit_scope not in ("all", "train"):
            raise ValueError(f"fit_scope must be 'all' or 'train', got {self.fit_scope!r}")
        if self.split_method not in ("hash", "random", "stratified"):
            raise ValueError(f"unknown split method {self.split_method!r}")


def experiment_grid(datasets: Sequence[str], classifiers: Sequence[str]) -> list[tuple[str, str]]:
    """(dataset, classifier) pairs, dataset outer."""
    return list(itertools.product(datasets, classifiers))


def prepare(spark: SparkSession, ds: ExperimentDataset, cfg: RunConfig) -> tuple[DataFrame, object]:
    """Normalised rows -> (materialised (label, features, split), feature model); the
    caller releases the table.

    The normalised rows are materialised once, pruned to the columns the
    model uses, so the vocabulary fit and the feature transform read that
    copy instead of re-running the normalisation; the copy is released as
    soon as the feature table is filled.
    """
    keys = list(ds.keys)
    if cfg.fit_scope == "train" and cfg.split_method == "hash" and keys and ds.load_fitted_on is not None:
        # The hash flag depends on the key only, so "training row" is known
        # before normalising: quantile cut points see training rows only.
        df = ds.load_fitted_on(spark, hash_split_flag(keys, cfg.train_ratio) == "train")
    else:
        df = ds.load(spark)
    roles = infer_column_roles(df.schema, ds.target, ds.numeric, ds.categorical, exclude=keys)
    used = [*keys, *roles.numeric, *roles.categorical, ds.target]
    df = df.select(*used)
    if cfg.partitions is not None:
        # After the projection: the shuffle carries only the columns the model uses.
        df = repartition_rows(df, cfg.partitions)
    else:
        df = spread_rows(df)
    split_keys = keys or used  # no id column: the whole (used) row is the key
    if cfg.split_method == "random" and cfg.fit_scope == "train":
        raise ValueError("fit_scope='train' needs a hash or stratified split")
    # One pass over the source: everything below reads this copy.  With
    # ``persist`` the first job below (the vocabulary or split count, which
    # scans every row) fills it, so no separate pass is spent on filling.
    rows = materialize(df, cfg.materialize, eager=False)
    try:
        if cfg.split_method == "random":
            feats, model = build_features(
                rows, ds.target, roles.numeric, roles.categorical, exclude=keys, max_categories=cfg.max_categories
            )
            train, test = random_split(feats.select(LABEL_COL, FEATURES_COL), cfg.train_ratio, cfg.seed)
            table = train.withColumn(SPLIT_COL, F.lit("train")).unionByName(
                test.withColumn(SPLIT_COL, F.lit("test"))
            )
        else:
            if cfg.split_method == "hash":
                flagged = hash_split(rows, split_keys, cfg.train_ratio)
            else:
                flagged = stratified_split(rows, split_keys, ds.target, cfg.train_ratio)
            fit_df = flagged.where(F.col(SPLIT_COL) == "train") if cfg.fit_scope == "train" else None
            feats, model = build_features(
                flagged, ds.target, roles.numeric, roles.categorical,
                exclude=[*keys, SPLIT_COL], fit_df=fit_df, max_categories=cfg.max_categories,
            )
            table = feats.select(LABEL_COL, FEATURES_COL, SPLIT_COL)
        out = materialize(table, cfg.materialize)
    finally:
        release(rows)
    return out, model


def _row(ds: str, clf: str, cfg: RunConfig, metrics: dict | None, error: str | None) -> dict:
    row = {
        "dataset": ds,
        "classifier": clf,
        "workers": cfg.workers,
        "partitions": cfg.partitions if cfg.partitions is not None else -1,
        "accuracy": None, "f1": None, "train_time_s": None, "predict_time_s": None, "total_time_s": None,
        "status": "ok" if error is None else "error",
        "error": error,
    }
    if metrics:
        row.update(metrics)
    return row


def run_experiments(
    spark: SparkSession,
    datasets: Sequence[ExperimentDataset],
    classifiers: ClassifierRegistry | None = None,
    dataset_filter: str | None = None,
    classifier_filter: str | None = None,
    config: RunConfig | None = None,
    resume: bool = False,
) -> list[dict]:
    """Run the grid and return metrics rows (also appended to ``config.sink``).

    With ``resume``, pairs whose successful row the sink holds are not run again:
    their rows are returned as they were stored (without confusion cells).  Durable
    tables that a dataset took are deleted when it is done, also if it fails.
    """
    cfg = config or RunConfig()
    registry = classifiers or default_classifiers()
    names = [d.name for d in datasets]
    if dataset_filter is not None and dataset_filter not in names:
        raise ValueError(f"no dataset is named {dataset_filter!r}; there are {names}")
    clf_names = registry.select(classifier_filter)
    if resume and cfg.sink is None:
        raise ValueError("only a run with a sink can be resumed")
    rows: list[dict] = []
    stored: dict[str, dict] = {}
    if cfg.sink is not None:
        cfg.sink.start(resume)
        stored = {pair_key(r): r for r in cfg.sink.finished()} if resume else {}
    for ds in datasets:
        if dataset_filter is not None and ds.name != dataset_filter:
            continue
        done = {clf: stored.get(pair_key(_row(ds.name, clf, cfg, None, None))) for clf in clf_names}
        rows += [r for r in done.values() if r]
        todo = [clf for clf in clf_names if not done[clf]]
        if todo:
            with leases_released():
                rows += _run_dataset(spark, ds, registry, todo, cfg)
    return rows


def _run_dataset(spark: SparkSession, ds: ExperimentDataset, registry: ClassifierRegistry, clf_names: list[str], cfg: RunConfig) -> list[dict]:
    try:
        table, _model = prepare(spark, ds, cfg)
    except Exception as e:  # skip-and-continue, recorded in the results
        return [_emit(cfg, _row(ds.name, clf, cfg, None, _err(e))) for clf in clf_names]

    def run(clf: str) -> dict:
        try:
            res = train_and_evaluate(train, test, registry.create(clf), cfg.eval_method)
            row = _row(ds.name, clf, cfg, res.as_metrics(), None)
        except Exception as e:
            row = _row(ds.name, clf, cfg, None, _err(e))
        return _emit(cfg, row)

    def run_in_pool(clf: str) -> dict:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{clf}")  # of this thread
        return run(clf)

    try:
        train, test = split_frames(table)
        if cfg.side_by_side == 1 or len(clf_names) == 1:
            return [run(clf) for clf in clf_names]
        with ThreadPoolExecutor(min(cfg.side_by_side, len(clf_names))) as pool:
            return list(pool.map(run_in_pool, clf_names))  # in the serial order; the block waits for all
    finally:
        release(table)


def _err(e: Exception) -> str:
    return f"{type(e).__name__}: {e}".strip() or traceback.format_exc(limit=1)


def _emit(cfg: RunConfig, row: dict) -> dict:
    if cfg.sink is not None:
        cfg.sink.append(row)
    return row
