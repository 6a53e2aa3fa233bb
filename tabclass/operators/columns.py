"""Projections, renames, casts and column roles.

Every operator here builds ONE projection (``select``) instead of a chain of
``withColumn`` calls, so the analysed plan stays flat however many columns a
dataset has, and Catalyst can prune the untouched input columns at the scan.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from tabclass.functions.casts import safe_double, safe_int, safe_long, trimmed_string


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop the named columns; names that are not present are ignored."""
    return df.drop(*list(columns))


def _converter(kind: str, df: DataFrame, name: str) -> Column:
    src = df.schema[name].dataType
    if kind == "int":
        return safe_int(name, src)
    if kind == "long":
        return safe_long(name, src)
    if kind == "double":
        return safe_double(name)
    if kind == "string":
        return trimmed_string(name)
    raise ValueError(f"unknown cast kind {kind!r}")


def cast_columns(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast columns in place (same name, same position), bad values -> NULL.

    ``casts`` maps column name -> one of ``int``, ``long``, ``double``,
    ``string`` (string also trims spaces).  All casts happen in one projection.
    """
    missing = [c for c in casts if c not in df.columns]
    if missing:
        raise ValueError(f"cannot cast missing columns: {missing}")
    return df.select(
        *[_converter(casts[c], df, c).alias(c) if c in casts else F.col(c) for c in df.columns]
    )


def cast_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return cast_columns(df, {c: "int" for c in columns})


def cast_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return cast_columns(df, {c: "long" for c in columns})


def cast_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return cast_columns(df, {c: "double" for c in columns})


def trim_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return cast_columns(df, {c: "string" for c in columns})


CONTRACT_TYPES: dict[str, DataType] = {
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "string": StringType(),
    "boolean": BooleanType(),
}


def select_contract(df: DataFrame, contract: StructType | Sequence[tuple[str, str]]) -> DataFrame:
    """Final typed projection: fixed order and types; a missing column is an error.

    ``contract`` is a ``StructType`` or a list of ``(name, type)`` pairs with
    types ``int long double string boolean``.  Casts are safe (bad -> NULL).
    """
    if not isinstance(contract, StructType):
        contract = StructType([StructField(n, CONTRACT_TYPES[t], True) for n, t in contract])
    missing = [f.name for f in contract.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"output contract needs missing columns: {missing}")
    cols = []
    for f in contract.fields:
        src = df.schema[f.name].dataType
        if src == f.dataType:
            cols.append(F.col(f.name))
        elif isinstance(f.dataType, IntegerType):
            cols.append(safe_int(f.name, src).alias(f.name))
        elif isinstance(f.dataType, LongType):
            cols.append(safe_long(f.name, src).alias(f.name))
        else:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def snake_case(name: str) -> str:
    """strip, lower case, spaces -> underscores."""
    return name.strip().lower().replace(" ", "_")


def rename_snake_case(df: DataFrame) -> DataFrame:
    """Rename every column to snake case; two columns mapping to one name is an error."""
    new = [snake_case(c) for c in df.columns]
    clashes = sorted({n for n in new if new.count(n) > 1})
    if clashes:
        raise ValueError(f"snake-case rename makes duplicate columns: {clashes}")
    return df.toDF(*new)


@dataclass(frozen=True)
class ColumnRoles:
    """Roles of a normalised table's columns for the feature pipeline."""

    target: str
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    ignored: list[str] = field(default_factory=list)

    def as_rows(self) -> list[tuple[str, str, int]]:
        rows = [(self.target, "target", 0)]
        rows += [(c, "numeric", i) for i, c in enumerate(self.numeric)]
        rows += [(c, "categorical", i) for i, c in enumerate(self.categorical)]
        rows += [(c, "ignored", i) for i, c in enumerate(self.ignored)]
        return rows


def infer_column_roles(
    schema: StructType,
    target: str,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
) -> ColumnRoles:
    """Numeric types -> numeric, strings -> categorical, other types -> ignored.

    Explicit ``numeric`` / ``categorical`` lists win over inference.  Columns
    in ``exclude`` (row keys, split flags) are reported as ignored.
    """
    if target not in schema.fieldNames():
        raise ValueError(f"target column {target!r} not in schema")
    inf_num, inf_cat, ignored = [], [], []
    for f in schema.fields:
        if f.name == target:
            continue
        if f.name in exclude:
            ignored.append(f.name)
        elif isinstance(f.dataType, NumericType):
            inf_num.append(f.name)
        elif isinstance(f.dataType, StringType):
            inf_cat.append(f.name)
        else:
            ignored.append(f.name)
    num = list(numeric) if numeric is not None else inf_num
    cat = list(categorical) if categorical is not None else inf_cat
    if numeric is not None or categorical is not None:
        used = set(num) | set(cat) | {target}
        ignored = [f.name for f in schema.fields if f.name not in used]
    return ColumnRoles(target=target, numeric=num, categorical=cat, ignored=ignored)


def roles_frame(spark, roles: ColumnRoles) -> DataFrame:
    """Column roles as a DataFrame (column, role, position)."""
    return spark.createDataFrame(
        roles.as_rows(), "column string, role string, position int"
    )


