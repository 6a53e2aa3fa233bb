"""Feature pipeline: label index, category index, one-hot, assembly.

The result is a real MLlib ``PipelineModel`` (savable, reusable on new data),
but the vocabularies are NOT fitted with ``StringIndexer.fit``: that call
builds a value -> count map for every column in each task and ships all of
them to the driver without any bound.  Here the counts are one DataFrame
aggregation (map-side combine, then a shuffle of distinct (column, value)
pairs only), their number is checked against ``max_categories``, if given,
before anything reaches the driver, and the ordered labels are handed to
``StringIndexerModel.from_arrays_of_labels``.  The ordering is
``StringIndexer``'s default: count descending, ties by value ascending.

Semantics kept from the reference:

* the label indexer uses ``handleInvalid="keep"``: the label metadata gets an
  extra ``__unknown`` class, and a NULL target becomes class K;
* a NULL or unseen category maps to index n and to an all-zero one-hot; the
  one-hot of a column with n categories has n slots (columns of very many
  categories are indexed by ``tabclass.operators.vocabulary`` instead);
* a NULL or NaN numeric drops the row (``VectorAssembler`` ``skip``);
* numerics come first in the feature vector (schema order), then one-hots.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabclass.operators.columns import ColumnRoles, infer_column_roles
from tabclass.operators.vocabulary import fit_vocabulary_table
from tabclass.operators.vocabulary import value_counts as _stacked_counts

DEFAULT_MAX_CATEGORIES = None  # no limit; callers may set one
LABEL_COL = "label"
FEATURES_COL = "features"


class TooManyCategories(ValueError):
    pass


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency ranking per column: (column, value, n, idx), StringIndexer order.
    A leased table of any size; no task ranks a whole column."""
    return fit_vocabulary_table(df, columns)


def fit_vocabularies(
    df: DataFrame, columns: Sequence[str], max_categories: int | None = DEFAULT_MAX_CATEGORIES
) -> dict[str, list[str]]:
    """Ordered labels per column, with a checked bound on their number."""
    columns = list(columns)
    if not columns:
        return {}
    counts = _stacked_counts(df, columns)
    cap = None if max_categories is None else max_categories * len(columns)
    rows = (counts if cap is None else counts.limit(cap + 1)).collect()
    per_col: dict[str, list[tuple[int, str]]] = {c: [] for c in columns}
    for r in rows:
        per_col[r["column"]].append((r["n"], r["value"]))
    if cap is not None and len(rows) > cap:
        sizes = {r["column"]: r["count"] for r in counts.groupBy("column").count().collect()}
        raise TooManyCategories(f"more than {max_categories} categories: {sizes}")
    if max_categories is not None:
        big = {c: len(v) for c, v in per_col.items() if len(v) > max_categories}
        if big:
            raise TooManyCategories(f"more than {max_categories} categories: {big}")
    return {c: [v for _, v in sorted(vals, key=lambda t: (-t[0], t[1]))] for c, vals in per_col.items()}


def label_indexer(labels: Sequence[str], target: str, output: str = LABEL_COL) -> StringIndexerModel:
    return StringIndexerModel.from_labels(
        list(labels), inputCol=target, outputCol=output, handleInvalid="keep"
    )


def category_indexers(vocab: dict[str, list[str]], columns: Sequence[str]) -> list[StringIndexerModel]:
    """One indexer per column (``from_arrays_of_labels`` pads uneven label
    lists with NULLs, which breaks the one-hot metadata)."""
    return [
        StringIndexerModel.from_labels(vocab[c], inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep")
        for c in columns
    ]


@dataclass
class FeatureModel:
    """Fitted feature pipeline plus what went into it."""

    pipeline: PipelineModel
    roles: ColumnRoles
    label_labels: list[str]
    vocabularies: dict[str, list[str]]

    @property
    def num_classes(self) -> int:
        return len(self.label_labels)

    def feature_names(self) -> list[str]:
        names = list(self.roles.numeric)
        for c in self.roles.categorical:
            names += [f"{c}={v}" for v in self.vocabularies[c]]
        return names

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(df)


def fit_feature_pipeline(
    df: DataFrame,
    target: str,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    max_categories: int | None = DEFAULT_MAX_CATEGORIES,
) -> FeatureModel:
    """Fit label + category vocabularies on ``df`` and assemble the stages.

    Jobs: one aggregation for the label and all categorical columns together.
    The one-hot encoder reads its sizes from the indexer metadata (no job).
    """
    roles = infer_column_roles(df.schema, target, numeric, categorical, exclude)
    if not roles.numeric and not roles.categorical:
        raise ValueError(f"no numeric or categorical feature columns besides {target!r}; ignored: {roles.ignored}")
    vocab = fit_vocabularies(df, [target, *roles.categorical], max_categories)
    stages: list = [label_indexer(vocab[target], target)]
    ohe_cols = [f"{c}_ohe" for c in roles.categorical]
    if roles.categorical:
        indexers = category_indexers(vocab, roles.categorical)
        stages.extend(indexers)
        encoder = OneHotEncoder(
            inputCols=[f"{c}_idx" for c in roles.categorical], outputCols=ohe_cols
        )
        # Sizes come from the indexers' nominal metadata; fitting reads only the schema.
        indexed = df.limit(0)
        for m in indexers:
            indexed = m.transform(indexed)
        stages.append(encoder.fit(indexed))
    stages.append(
        VectorAssembler(
            inputCols=[*roles.numeric, *ohe_cols], outputCol=FEATURES_COL, handleInvalid="skip"
        )
    )
    return FeatureModel(
        pipeline=PipelineModel(stages),
        roles=roles,
        label_labels=vocab[target],
        vocabularies={c: vocab[c] for c in roles.categorical},
    )


def build_features(
    df: DataFrame,
    target: str,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    fit_df: DataFrame | None = None,
    max_categories: int | None = DEFAULT_MAX_CATEGORIES,
) -> tuple[DataFrame, FeatureModel]:
    """Fit on ``fit_df`` (default: ``df``, the reference's all-rows scope) and transform ``df``."""
    model = fit_feature_pipeline(
        fit_df if fit_df is not None else df, target, numeric, categorical, exclude, max_categories
    )
    return model.transform(df), model


def with_feature_array(df: DataFrame, column: str = FEATURES_COL, alias: str | None = None) -> DataFrame:
    """Vector column -> array<double>, so results can be compared with SQL."""
    return df.withColumn(alias or column, vector_to_array(F.col(column)))
