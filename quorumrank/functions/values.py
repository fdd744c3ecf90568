"""Lenient parsing, calendar and formatting functions."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_int(value: Column) -> Column:
    """Whole numbers with blanks around; anything else is null."""
    return F.when(F.trim(value).rlike(r"^[+-]?[0-9]+$"), F.trim(value)).try_cast("long")


def lenient_double(value: Column) -> Column:
    return F.trim(value).try_cast("double")


def lenient_date(value: Column) -> Column:
    """Date of an ISO date or timestamp (its own zone's day), else of the first ten characters, else null."""
    text = F.trim(F.when(~value.isin("", "None", "null"), value))
    return F.coalesce(F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"), F.try_to_date(F.substring(text, 1, 8), "yyyyMMdd"))


def month_start(yyyymm: Column) -> Column:
    return F.to_date(yyyymm.cast("string"), "yyyyMM")


def iso_week_tag(day: Column) -> Column:
    """data-YYYY-WNN of a date, by ISO year and week."""
    return F.format_string("data-%04d-W%02d", F.extract(F.lit("YEAROFWEEK"), day), F.weekofyear(day))


def week_tag(day: datetime.date) -> str:
    year, week, _ = day.isocalendar()
    return f"data-{year:04d}-W{week:02d}"


def week_of_tag(tag: str) -> datetime.date:
    """Monday of a tag's week; raises on anything else."""
    m = re.fullmatch(r"data-(\d{4})-W(\d{2})", tag)
    if not m:
        raise ValueError(f"not a weekly tag: {tag}")
    return datetime.date.fromisocalendar(int(m[1]), int(m[2]), 1)


def week_grid(tag: str, weeks: int = 8) -> list[str]:
    """The tags of ``weeks`` weeks up to ``tag``, oldest first."""
    last = week_of_tag(tag)
    return [week_tag(last - datetime.timedelta(weeks=k)) for k in reversed(range(weeks))]


def select_history(tags: list[str], current: str, count: int = 8) -> list[str]:
    """Those of the last ``count`` weekly tags up to ``current`` that exist; ``current`` must."""
    if current not in tags:
        raise ValueError(f"{current} isn't among the releases")
    return [t for t in week_grid(current, count) if t in set(tags)]


def week_grid_column(day: Column, weeks: int = 8) -> Column:
    """Array of the Mondays of ``weeks`` weeks up to a date's."""
    monday = F.date_trunc("week", day).cast("date")
    return F.sequence(F.date_sub(monday, 7 * (weeks - 1)), monday, F.expr("interval 7 days"))


def default_month(today: datetime.date) -> int:
    """The newest month, as yyyymm, that a table published in the second week surely has: last month's from day 14 on."""
    month = today.year * 12 + today.month - 1 - (1 if today.day >= 14 else 2)
    return month // 12 * 100 + month % 12 + 1


def age_days(now: Column, then: Column) -> Column:
    """Whole days between two timestamps."""
    return F.floor((F.unix_timestamp(now) - F.unix_timestamp(then)) / 86400)


def lenient_json(text: Column) -> Column:
    """A JSON object as it is; anything else wrapped as {"raw": text}; null and blank stay null."""
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))
    return F.when(is_object, text).when(F.trim(text) != "", F.to_json(F.struct(text.alias("raw"))))


def header_key(name: str) -> str:
    """Lower-case letters and digits of a header."""
    return re.sub(r"[^a-z0-9]", "", name.lower())


def fmt_int(value: object) -> str:
    return "" if value is None or value != value else f"{int(value):,}"


def fmt_float(value: float | None, digits: int = 3) -> str:
    return "" if value is None or value != value else f"{value:.{digits}f}"


def fmt_pct(a: float | None, b: float | None, digits: int = 2) -> str:
    return "" if a is None or not b else f"{100 * a / b:.{digits}f}%"


def redact(text: str, secrets: list[str]) -> str:
    for s in filter(None, secrets):
        text = text.replace(s, "<redacted>")
    return text
