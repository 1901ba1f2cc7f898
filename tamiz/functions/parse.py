"""Dirty text to typed values. Each parser gives struct<value.., reason>; none raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.fixed_values import CLIENT_PATTERN, NATIONAL_ID_PATTERN, USD_PER_EUR
from tamiz.functions.text import bind, strip_space


def shown(text: Column) -> Column:
    """The raw value as it appears inside a reason."""
    return F.coalesce(text, F.lit("None"))


def money(text: Column, label: str = "Importe", usd_per_eur: float = USD_PER_EUR) -> Column:
    """struct<value double, reason string>: amount in EUR, rounded to cents.

    Symbols are dropped and a comma reads as a decimal point, so '1.234,56' is not a
    number. Dollars are recognised anywhere in the text.
    """

    def read(clean: Column) -> Column:
        digits = F.translate(F.regexp_replace(clean, r"[^0-9,.\-]", ""), ",", ".")
        return bind(digits, lambda d: bind(as_number(d), lambda number: judge(clean, number)))

    def as_number(digits: Column) -> Column:
        # Told apart by pattern first: a failing cast costs an exception.
        return F.when(digits.rlike(r"^-?(\d+\.?\d*|\.\d+)$"), digits.try_cast("double"))

    def judge(clean: Column, number: Column) -> Column:
        blank = clean.isNull() | clean.isin("", "NULL")
        reason = (
            F.when(blank, F.concat(F.lit(f"{label} nulo o vacío: "), shown(text)))
            .when(number.isNull(), F.concat(F.lit(f"{label} no numérico: "), text))
            .when(number < 0, F.concat(F.lit(f"{label} negativo: "), text))
        )
        dollars = clean.contains("USD") | clean.contains("$")
        euros = F.when(dollars, number / F.lit(float(usd_per_eur))).otherwise(number)
        value = F.when(~blank & (number >= 0), F.round(euros, 2))
        return F.struct(value.alias("value"), reason.alias("reason"))

    return bind(F.upper(strip_space(text)), read)


def date(text: Column) -> Column:
    """struct<value date, reason string>: ISO, then day-first, then month-first."""

    def assemble(parts: Column, month: int, day: int) -> Column:
        # Impossible months are told apart first: a failing cast costs an exception.
        possible = parts[month].try_cast("int").between(1, 12)
        return F.when(
            possible, F.concat_ws("-", parts[2], parts[month], parts[day]).try_cast("date")
        )

    def read(clean: Column) -> Column:
        slashed = bind(
            F.split(clean, "/"), lambda p: F.coalesce(assemble(p, 1, 0), assemble(p, 0, 1))
        )
        value = F.when(
            clean.rlike(r"^(?!0000)\d{4}-\d{2}-\d{2}$"), clean.try_cast("date")
        ).when(clean.rlike(r"^\d{1,2}/\d{1,2}/(?!0000)\d{4}$"), slashed)
        return bind(value, lambda day: judge(clean, day))

    def judge(clean: Column, day: Column) -> Column:
        blank = clean.isNull() | F.upper(clean).isin("", "INVALID_DATE")
        reason = F.when(blank, F.concat(F.lit("Fecha inválida: "), shown(text))).when(
            day.isNull(), F.concat(F.lit("Formato de fecha no reconocido: "), clean)
        )
        return F.struct(day.alias("value"), reason.alias("reason"))

    return bind(strip_space(text), read)


def client(text: Column) -> Column:
    """struct<nombre, apellidos, dni, reason> from 'Surnames, Name - ID' (ID optional)."""

    def part(group: int) -> Column:
        return F.regexp_extract(text, CLIENT_PATTERN, group)

    matched = text.rlike(CLIENT_PATTERN)
    name = F.when(matched, part(2))
    surnames = F.when(matched, part(1))
    identity = F.when(matched, F.nullif(part(3), F.lit("")))
    well_formed = identity.rlike(NATIONAL_ID_PATTERN)
    reason = (
        F.when(
            text.isNull() | (strip_space(text) == ""),
            F.concat(F.lit("Cliente_Data nulo o vacío: "), shown(text)),
        )
        .when(~matched, F.concat(F.lit("Formato Cliente_Data no reconocido: "), text))
        .when(identity.isNull(), F.concat(F.lit("DNI ausente: "), text))
        .when(~well_formed, F.concat(F.lit("DNI con formato inválido: "), identity))
    )
    return F.struct(
        name.alias("nombre"),
        surnames.alias("apellidos"),
        F.when(well_formed, F.upper(identity)).otherwise(identity).alias("dni"),
        reason.alias("reason"),
    )


def iso_candidate(text: Column) -> Column:
    """A yyyy-MM-dd candidate judged only by length and separator positions."""

    def separators(first: int, second: int, mark: str) -> Column:
        return (
            (F.length(text) == 10)
            & (F.substring(text, first, 1) == mark)
            & (F.substring(text, second, 1) == mark)
        )

    turned = F.concat_ws(
        "-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2)
    )
    return F.when(separators(5, 8, "-"), text).when(
        separators(3, 6, "/") | separators(3, 6, "-"), turned
    )


def in_calendar_range(candidate: Column) -> Column:
    """The candidate if month is 01..12 and day 01..31 as text, else NULL."""
    month, day = F.substring(candidate, 6, 2), F.substring(candidate, 9, 2)
    return F.when(month.between("01", "12") & day.between("01", "31"), candidate)


def count_or_zero(text: Column) -> Column:
    """Integer; blank or 'NULL' reads as 0; anything else unreadable is NULL."""
    return F.when((F.length(text) == 0) | (F.upper(text) == "NULL"), 0).otherwise(
        text.try_cast("int")
    )
