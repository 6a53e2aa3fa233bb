"""Dataset specs and the catalog of known datasets.

A ``DatasetSpec`` is what a reference ``DatasetLoader`` subclass was: name,
path, target column, size category, plus the normalisation and, optionally,
an explicit raw schema and a custom loader.  New datasets are added by
registering a spec, not by subclassing.
"""
from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabclass.operators.partitioning import balance_partitions
from tabclass.plans import recipes
from tabclass.sources.csv_records import read_csv_records
from tabclass.sources.files import header_text_schema, read_csv

#: Rows that rule out most columns before a full pass looks at the rest.
BOOLEAN_HEAD = 1000

SIZE_CATEGORIES = ("small", "medium", "large")


def boolean_text_columns(df: DataFrame) -> list[str]:
    """Text columns whose values are all ``true`` or ``false`` in any case, as type
    inference decides.  The first rows rule out nearly all columns; only those left,
    usually none, cost a pass, over themselves alone."""
    names = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    for rows in (df.limit(BOOLEAN_HEAD), df):
        if not names:
            return []
        said = [F.bool_and(F.lower(F.col(f"`{c}`")).isin("true", "false")) for c in names]
        found = rows.agg(*said).first()
        # All null so far: a candidate, but no boolean column if it stays so.
        names = [c for c, yes in zip(names, found) if yes or (yes is None and rows is not df)]
    return names


def with_booleans(df: DataFrame) -> DataFrame:
    """``df`` with the columns that hold only true and false as booleans, so that a cast
    to a number gives 1 and 0."""
    flags = set(boolean_text_columns(df))
    made = lambda c: (F.lower(F.col(f"`{c}`")) == "true").alias(c) if c in flags else F.col(f"`{c}`")
    return df.select(*[made(c) for c in df.columns]) if flags else df


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    path: str
    target_column: str
    size_category: str
    normalize: Callable[[DataFrame], DataFrame] = field(default=lambda df: df, compare=False)
    schema: StructType | None = field(default=None, compare=False)
    multi_line: bool = True
    infer_types: bool = False
    loader: Callable[[SparkSession, "DatasetSpec"], DataFrame] | None = field(default=None, compare=False)

    def __post_init__(self) -> None:
        if self.size_category not in SIZE_CATEGORIES:
            raise ValueError(f"size_category must be one of {SIZE_CATEGORIES}, got {self.size_category!r}")

    def load(self, spark: SparkSession, root: str | None = None) -> DataFrame:
        """The raw rows.  A custom loader gets this spec with the path below ``root``."""
        path = self.path if root is None or os.path.isabs(self.path) else os.path.join(root, self.path)
        if self.loader is not None:
            return self.loader(spark, replace(self, path=path))
        if not self.infer_types:
            # The recipes cast every column from text: no inference of types needed.
            if self.multi_line:
                df = read_csv_records(spark, path, self.schema)
            else:
                df = read_csv(spark, path, schema=self.schema or header_text_schema(spark, path))
            return df if self.schema is not None else with_booleans(df)
        df = read_csv(spark, path, schema=self.schema, multi_line=self.multi_line)
        # Spark's own multi-line reader is one task per file however large: spread it
        # before normalising (no-op when there are already enough splits).
        return balance_partitions(df) if self.multi_line else df

    def run(self, spark: SparkSession, root: str | None = None) -> DataFrame:
        """load, then normalise."""
        return self.load(spark, root).transform(self.normalize)


# Fixed values that must equal the reference: the four datasets, in run order.
REFERENCE_DATASETS: list[DatasetSpec] = [
    DatasetSpec(
        "gen_z_social",
        "data/raw/gen_z_social/genz_social_media_usage_1M.csv",
        "addiction_level",
        "medium",
        normalize=recipes.normalize_social,
    ),
    DatasetSpec(
        "fraud_detection",
        "data/raw/fraud_detection/fraudTrain.csv",
        "is_fraud",
        "large",
        normalize=recipes.normalize_fraud,
    ),
    DatasetSpec(
        "lol_matches",
        "data/raw/lol_matches/league_data.csv",
        "win",
        "large",
        normalize=lambda df: recipes.normalize_matches(df, recipes.lol_matches_columns()),
    ),
    DatasetSpec(
        "job_salary",
        "data/raw/job_salary/job_salary_prediction_dataset.csv",
        "salary_category",
        "medium",
        normalize=recipes.normalize_salary,
    ),
]


class DatasetRegistry:
    """Ordered name -> spec mapping; unknown names raise."""

    def __init__(self, specs: list[DatasetSpec] | None = None):
        self._specs: dict[str, DatasetSpec] = {}
        for s in specs or []:
            self.register(s)

    def register(self, spec: DatasetSpec) -> None:
        self._specs[spec.name] = spec

    def get(self, name: str) -> DatasetSpec:
        if name not in self._specs:
            raise KeyError(f"unknown dataset {name!r}; available: {list(self._specs)}")
        return self._specs[name]

    def select(self, name: str | None = None) -> list[DatasetSpec]:
        return [self.get(name)] if name else list(self._specs.values())

    def names(self) -> list[str]:
        return list(self._specs)

    def frame(self, spark: SparkSession) -> DataFrame:
        return catalog_frame(spark, list(self._specs.values()))


CATALOG_SCHEMA = "position int, name string, path string, target_column string, size_category string"


def catalog_frame(spark: SparkSession, specs: list[DatasetSpec]) -> DataFrame:
    """The catalog as a DataFrame: (position, name, path, target_column, size_category)."""
    return spark.createDataFrame(
        [(i, s.name, s.path, s.target_column, s.size_category) for i, s in enumerate(specs)],
        CATALOG_SCHEMA,
    )


def reference_registry(exact_quantiles: bool = False) -> DatasetRegistry:
    """The four reference datasets; ``exact_quantiles`` cuts the salary terciles
    at exact ``percentile_disc`` values instead of the reference's GK estimate."""
    specs = list(REFERENCE_DATASETS)
    if exact_quantiles:
        exact = recipes.SalaryColumns(quantile_method="exact")
        specs = [
            replace(s, normalize=lambda df: recipes.normalize_salary(df, exact)) if s.name == "job_salary" else s
            for s in specs
        ]
    return DatasetRegistry(specs)
