"""Declared contracts: coercion, row-level reasons, and the valid / quarantine split.

All checks are Column expressions on the row, so a contract costs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tamiz.runtime import computed_once

REASON = "motivo_rechazo"


@dataclass(frozen=True)
class Rule:
    """What one column must satisfy. Ranges are closed; nulls fail only `nullable`."""

    column: str
    type: str = "string"
    nullable: bool = False
    allowed: Sequence[str] | None = None
    between: tuple[float, float] | None = None
    pattern: str | None = None

    def coerced(self) -> Column:
        value = F.col(self.column).try_cast(self.type)
        if self.type in ("double", "float"):
            return F.when(~F.isnan(value), value)
        return value

    def reasons(self) -> list[Column]:
        """One nullable text per check, evaluated on the coerced column."""
        value, found = F.col(self.column), []
        if not self.nullable:
            found.append(F.when(value.isNull(), f"{self.column}: not_nullable"))
        if self.allowed is not None:
            listed = list(self.allowed)
            found.append(F.when(~value.isin(listed), f"{self.column}: isin({listed})"))
        if self.between is not None:
            low, high = self.between
            found.append(
                F.when(~value.between(low, high), f"{self.column}: in_range({low}, {high})")
            )
        if self.pattern is not None:
            found.append(
                F.when(
                    ~value.rlike(f"^(?:{self.pattern})"),
                    f"{self.column}: str_matches({self.pattern})",
                )
            )
        return found


@dataclass(frozen=True)
class Contract:
    rules: Sequence[Rule] = field(default_factory=tuple)

    def coerce(self, df: DataFrame) -> DataFrame:
        """Type the declared columns; unreadable values become NULL, extra columns stay."""
        missing = [r.column for r in self.rules if r.column not in df.columns]
        if missing:
            raise ValueError(f"missing columns: {missing}")
        return df.withColumns({r.column: r.coerced() for r in self.rules})

    def tag(self, df: DataFrame, reason: str = REASON) -> DataFrame:
        """Coerce and add all failed checks as one text, NULL for a valid row."""
        checks = [check for rule in self.rules for check in rule.reasons()]
        return computed_once(self.coerce(df), {reason: join_reasons(checks)})

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        return split_by_reason(self.tag(df))


def join_reasons(checks: Sequence[Column], separator: str = "; ") -> Column:
    """All failed checks of a row in order, NULL when none failed."""
    return F.nullif(F.concat_ws(separator, *checks), F.lit(""))


def first_reason(checks: Sequence[tuple[Column, Column | str]]) -> Column:
    """The text of the first true condition, NULL when none is true."""
    return F.coalesce(*[F.when(condition, text) for condition, text in checks], F.lit(None))


def ordered_branch(cases: Sequence[tuple[str, Column]], default: str) -> Column:
    """Name of the first branch whose condition holds (an ordered conditional split)."""
    return first_reason([(c, F.lit(n)) for n, c in cases] + [(F.lit(True), F.lit(default))])


def split_by_reason(tagged: DataFrame, reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    valid = tagged.filter(F.col(reason).isNull()).drop(reason)
    return valid, tagged.filter(F.col(reason).isNotNull())


def error_rows(df: DataFrame, table: str, checks: Sequence[tuple[Column, Column]]) -> DataFrame:
    """One row (tabla_origen, datos_raw, motivo_rechazo) per failed check.

    `checks` are (raw text, nullable reason) pairs, all evaluated in one scan.
    """
    entries = F.array(
        *[F.struct(raw.alias("datos_raw"), reason.alias(REASON)) for raw, reason in checks]
    )
    failed = F.filter(entries, lambda entry: entry[REASON].isNotNull())
    return df.select(F.lit(table).alias("tabla_origen"), F.inline(failed))


def counted(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """Count rows while they flow past, total and per condition, without another scan."""
    observation = Observation(name)
    counters = [F.count(F.lit(1)).alias("rows")]
    counters += [F.count_if(condition).alias(label) for label, condition in conditions.items()]
    return df.observe(observation, *counters), observation


def reason_frequency(quarantine: DataFrame, reason: str = REASON) -> DataFrame:
    return (
        quarantine.groupBy(reason)
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.desc("total"), reason)
    )


def conservation(tagged: DataFrame, reason: str = REASON) -> DataFrame:
    """Rows in, valid and rejected from one pass, and whether they add up."""
    counts = tagged.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(F.col(reason).isNull()).alias("valid_rows"),
        F.count_if(F.col(reason).isNotNull()).alias("rejected_rows"),
    )
    return counts.withColumn(
        "conserved", F.col("input_rows") == F.col("valid_rows") + F.col("rejected_rows")
    )


def scope_filter(
    df: DataFrame, keys: Sequence[str], in_scope: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(kept, out of scope): out-of-scope rows are counted by callers, not quarantined."""
    scope = in_scope.select(*keys).distinct()
    return df.join(scope, list(keys), "left_semi"), df.join(scope, list(keys), "left_anti")
