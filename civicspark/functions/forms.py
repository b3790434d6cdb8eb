"""Checks of delivered fields: allowed values, lengths and patterns, with the first thing wrong by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns of an e-mail address, a request id, a company number as typed, and a slug.
EMAIL = r"^[^\s<>@,;]+@[^\s<>@,;]+\.[^\s<>@,;]+$"
REQUEST_ID = r"^[a-zA-Z0-9-]{16,64}$"
COMPANY = r"^[0-9./ -]+$"
SLUG = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"

#: What is kept of where a request came from.
ORIGIN_KEYS = ["page", "cta", "sector", "source", "campaign", "utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term"]


def plain(c: Column, most: int = 256) -> Column:
    """A text field that is present, of at most ``most`` characters and without a null character."""
    return c.isNotNull() & (F.length(c) <= most) & ~c.contains("\0")


def is_email(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).rlike(EMAIL), F.lit(False))


def is_request_id(c: Column) -> Column:
    return F.coalesce(c.rlike(REQUEST_ID), F.lit(False))


def company_number(c: Column) -> Column:
    """The fourteen digits of a company number; null where it has other characters or another length."""
    digits = F.regexp_replace(c, r"\D", "")
    return F.when(c.rlike(COMPANY) & (F.length(digits) == 14), digits)


def origin(values: Column) -> Column:
    """A map of where a request came from, with the known keys only and without values that are long or could be markup, an address or a line break."""
    return F.map_filter(values, lambda k, v: k.isin(ORIGIN_KEYS) & (F.length(v) <= 160) & ~v.rlike(r"[@<>?\r\n]"))


def checked(rows: DataFrame, rules: dict[str, Column], out: str = "erro") -> DataFrame:
    """The rows with the name of the first rule they break, null if none; a rule that is null is broken. Rows with and without an error are the
    quarantined and the valid ones."""
    first = reduce(lambda c, r: c.when(~F.coalesce(r[1], F.lit(False)), F.lit(r[0])), rules.items(), F.when(F.lit(False), F.lit("")))
    return rows.withColumn(out, first)
