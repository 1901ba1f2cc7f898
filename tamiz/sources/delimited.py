"""Delimited text sources and text sheets."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_text_table(
    spark: SparkSession, path: str, columns: Sequence[str], separator: str = ";"
) -> DataFrame:
    """Headed UTF-8 text, no quoting, all strings; zero-length fields stay ''."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).csv(path, sep=separator, header=True, quote="")
    return rows.fillna("")


def split_text_table(
    spark: SparkSession, path: str, columns: Sequence[str], separator: str = ";"
) -> tuple[DataFrame, DataFrame]:
    """(rows, ragged) of headed UTF-8 text without quoting. Lines with too few or too many fields keep their
    text and a reason; blank lines and the header of each file are neither."""
    lines = spark.read.text(path).withColumn("datos_raw", F.regexp_replace("value", "^\uFEFF|\r$", ""))
    lines = lines.filter((F.trim("datos_raw") != "") & (F.col("datos_raw") != separator.join(columns)))
    fields = F.split("datos_raw", re.escape(separator), -1)
    found = lines.select("datos_raw", fields.alias("_fields"), F.size(fields).alias("_count"))
    told = F.concat(F.col("_count").cast("string"), F.lit(f" fields instead of {len(columns)}"))
    ragged = found.filter(F.col("_count") != len(columns)).select(told.alias("motivo_rechazo"), "datos_raw")
    whole = found.filter(F.col("_count") == len(columns))
    return whole.select(*[F.col("_fields")[k].alias(c) for k, c in enumerate(columns)]), ragged


def read_staged(spark: SparkSession, path: str, schema: str, separator: str = "|") -> DataFrame:
    """A typed bulk load; a value that does not fit its type fails the job."""
    return spark.read.schema(schema).csv(
        path, sep=separator, header=True, mode="FAILFAST", multiLine=False, escape='"'
    )


def sheet_rows(sheet: DataFrame, text: str, pattern: str, group: int, value: str) -> DataFrame:
    """Rows of a text sheet whose trimmed first cell matches, with one group as their id."""
    cell: Column = F.trim(F.col(text))
    return sheet.filter(cell.rlike(pattern)).select(
        F.regexp_extract(cell, pattern, group).alias("id"), F.col(value)
    )
