"""Whole rows as text or JSON, and per-run stamps."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_values(names: dict[str, Column], separator: str = "; ") -> Column:
    """'a=1; b=2' with NULL shown as ''."""
    parts = [
        F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("")))
        for name, value in names.items()
    ]
    return F.concat_ws(separator, *parts)


def raw_cell(key_name: str, key: Column, cell_name: str, cell: Column, quoted: bool = True) -> Column:
    """"VentaID=7 Fecha='..'": the rejected cell with the key of its row."""
    mark = "'" if quoted else ""
    return F.concat(
        F.lit(f"{key_name}="),
        F.coalesce(key.cast("string"), F.lit("None")),
        F.lit(f" {cell_name}={mark}"),
        F.coalesce(cell.cast("string"), F.lit("None")),
        F.lit(mark),
    )


def row_json(*columns: Column | str) -> Column:
    """The row as JSON, NULL fields included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_field(document: Column, field: str) -> Column:
    return F.get_json_object(document, f"$.{field}")


def new_batch() -> tuple[str, str]:
    """(batch id, UTC ingest stamp), decided once per run on the driver."""
    return uuid.uuid4().hex[:12], datetime.now(timezone.utc).isoformat()
