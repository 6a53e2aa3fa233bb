"""File sources and sinks (CSV, Parquet)."""
from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


#: Lines a header may span.
HEADER_LINES = 100


def header_names(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names of the header record, which may span lines."""
    taken = ""
    for row in spark.read.text(path, lineSep="\n").head(HEADER_LINES):
        taken += ("\n" if taken else "") + row[0]
        if taken.count('"') % 2 == 0:
            return next(csv.reader(io.StringIO(taken.removeprefix("﻿").removesuffix("\r"), newline="")))
    raise ValueError(f"no header record in the first {HEADER_LINES} lines of {path!r}")


def text_schema(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def header_text_schema(spark: SparkSession, path: str | list[str]) -> StructType:
    """All-text schema named by the CSV header, read from its first lines alone.

    It replaces ``inferSchema`` (a full extra parse of every file) when the
    normalisation casts every column from text anyway.
    """
    return text_schema(header_names(spark, path))


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    multi_line: bool = False,
    header: bool = True,
    escape: str = '"',
) -> DataFrame:
    """RFC-4180 CSV: header row, doubled quotes inside quoted fields.

    ``path`` may be a file, a folder, a glob or a list of them.  Pass a
    ``schema`` in production: inference is an extra full read of the input.
    ``multi_line`` allows newlines inside quoted fields, but makes each file
    one unsplittable task; ``read_csv_records`` reads such files in parallel.  An empty field reads as NULL; the
    text ``NULL`` stays text (normalisation handles it).
    """
    reader = (
        spark.read.option("header", str(header).lower())
        .option("multiLine", str(multi_line).lower())
        .option("escape", escape)
        .option("enforceSchema", "false")  # a header that differs from the schema raises
    )
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """CSV that ``read_csv(multi_line=True)`` reads back unchanged (quotes doubled,
    leading/trailing spaces kept)."""
    (
        df.write.mode(mode)
        .option("header", str(header).lower())
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
