"""File exports: immutable raw batches, CSV, staging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.operators.contract import counted
from tamiz.sources.envelope import LANDING_FOLDERS


# Blanks around a value are kept, and a quote inside one is doubled, as CSV readers expect.
WHOLE_TEXT = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}


def land_envelopes(envelopes: DataFrame, path: str) -> None:
    """Append raw envelopes below ciudad=/fecha_ingesta=; earlier batches are never touched.

    Envelopes of a folder are brought together first, or every task would write a file
    into every folder; adaptive execution splits a folder that is large.
    """
    day = F.substring("metadata.timestamp_ingesta_utc", 1, 10)
    keyed = envelopes.withColumns({"ciudad": F.col("metadata.ciudad"), "fecha_ingesta": day})
    gathered = keyed.hint("rebalance", *LANDING_FOLDERS)
    gathered.write.mode("append").partitionBy(*LANDING_FOLDERS).json(path)


def export_csv(df: DataFrame, path: str) -> int:
    """Write headed CSV; returns the number of rows, counted while they are written."""
    watched, seen = counted(df, "export")
    watched.write.mode("overwrite").options(header=True, **WHOLE_TEXT).csv(path)
    return seen.get["rows"]


def write_staging(df: DataFrame, path: str, separator: str = "|", quoted: bool = True) -> None:
    """Replace a delimited staging file set; unquoted text must not hold the separator."""
    writer = df.write.mode("overwrite").options(header=True, sep=separator, **WHOLE_TEXT)
    if not quoted:
        writer = writer.option("quote", "").option("emptyValue", "")
    writer.csv(path)


def labelled_union(valid: DataFrame, rejected: DataFrame, columns: dict[str, dict]) -> DataFrame:
    """Valid and rejected rows as one table; `columns` gives each side's literal columns."""
    sides = [
        df.withColumns({name: F.lit(value) for name, value in columns[side].items()})
        for side, df in (("valid", valid), ("rejected", rejected))
    ]
    return sides[0].unionByName(sides[1], allowMissingColumns=True)
