"""Row filters and null rules."""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dropna_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``columns`` is NULL (or NaN for floating columns)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"dropna on missing columns: {missing}")
    return df.na.drop(how="any", subset=list(columns))


def dropna_any(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL or NaN in any column."""
    return df.na.drop(how="any")


def filter_allowed(df: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    """Keep rows whose ``column`` is one of ``allowed``; NULL is rejected."""
    values = list(allowed)
    if not values:
        raise ValueError("allowed-value filter needs at least one value")
    return df.filter(F.col(column).isin(values))


def allowed_value_report(df: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    """(value, n, kept) counts of a column against an allowed set (one pass).

    The reference silently loses every row when a target arrives as
    ``true``/``false`` instead of ``1``/``0``; this report makes that visible.
    """
    values = list(allowed)
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("kept", F.coalesce(F.col("value").isin(values), F.lit(False)))
    )


# Fixed values that must equal the reference: text that counts as a missing target.
MISSING_TARGET_TEXT = ("NULL", "")


def impute_target_default(
    df: DataFrame, column: str, default: str = "0", policy: str = "impute"
) -> DataFrame:
    """NULL, ``"NULL"`` and ``""`` in ``column`` become ``default`` (policy ``impute``).

    ``policy="drop"`` removes those rows instead (what the reference's
    docstring promised, while its code imputes).
    """
    c = F.col(column)
    missing = c.isNull() | c.isin(list(MISSING_TARGET_TEXT))
    if policy == "impute":
        return df.withColumn(column, F.when(missing, F.lit(default)).otherwise(c))
    if policy == "drop":
        return df.filter(~missing)
    raise ValueError(f"unknown missing-target policy {policy!r}")


def map_boolean_text(df: DataFrame, column: str, true: str = "1", false: str = "0") -> DataFrame:
    """Optional repair: ``true``/``false`` (any case) -> ``true``/``false`` text codes."""
    c = F.lower(F.col(column).cast("string"))
    return df.withColumn(
        column,
        F.when(c == "true", F.lit(true)).when(c == "false", F.lit(false)).otherwise(F.col(column).cast("string")),
    )


def valid(numeric: Sequence[str]) -> Column:
    """Whether the assembler takes a row: no numeric column is NULL or NaN."""
    good = F.lit(True)
    for c in numeric:
        value = F.col(c).cast("double")
        good = good & value.isNotNull() & ~F.isnan(value)
    return good


def invalid_rows(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Rows that the assembler skips: any numeric column is NULL or NaN.  One
    narrow filter; ``count()`` of it is the number of skipped rows."""
    return df.where(~valid(numeric))
