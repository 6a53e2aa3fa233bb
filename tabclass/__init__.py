"""tabclass: prepare tables and compare MLlib classifiers on them, Spark-first.

The most used entry points, re-exported::

    from tabclass import RunConfig, run_experiments, dataset_from_spec, reference_registry
"""
__version__ = "0.1.0"

from tabclass.operators.evaluate import confusion_matrix, evaluate, per_class_metrics
from tabclass.operators.features import build_features, fit_feature_pipeline
from tabclass.operators.quantiles import approx_quantiles, exact_quantiles, tercile_target
from tabclass.operators.split import hash_split, random_split, stratified_split, train_test_split
from tabclass.plans.experiments import ExperimentDataset, RunConfig, dataset_from_spec, run_experiments
from tabclass.plans.models import ClassifierRegistry, default_classifiers
from tabclass.plans.results import per_class_report, sweep_speedup, time_by_classifier
from tabclass.plans.training import train_and_evaluate
from tabclass.sources.catalog import DatasetSpec, reference_registry
from tabclass.sources.metrics_store import MetricsSink, metrics_frame, read_metrics

__all__ = [
    "ClassifierRegistry",
    "DatasetSpec",
    "ExperimentDataset",
    "MetricsSink",
    "RunConfig",
    "approx_quantiles",
    "build_features",
    "confusion_matrix",
    "dataset_from_spec",
    "default_classifiers",
    "evaluate",
    "exact_quantiles",
    "fit_feature_pipeline",
    "hash_split",
    "metrics_frame",
    "per_class_metrics",
    "per_class_report",
    "random_split",
    "read_metrics",
    "reference_registry",
    "run_experiments",
    "stratified_split",
    "sweep_speedup",
    "tercile_target",
    "time_by_classifier",
    "train_and_evaluate",
    "train_test_split",
]
