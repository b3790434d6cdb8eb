"""Dates and times as they come in official records, as column expressions with an explicit reference day."""

from __future__ import annotations

import re
from itertools import pairwise

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_prefix(c: Column) -> Column:
    """A leading YYYY-MM-DD as it stands, else null."""
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"^\d{4}-\d{2}-\d{2}", 0), F.lit(""))


def valid_day(c: Column) -> Column:
    """The leading YYYY-MM-DD as a date; null if it isn't one of the calendar."""
    return F.try_to_date(day_prefix(c), "yyyy-MM-dd")


def any_day(c: Column) -> Column:
    """YYYY-MM-DD from an ISO day anywhere in the text, from d/m/yyyy with / . or -, or from Unix time in seconds (ten digits) or milliseconds (thirteen); null for anything else."""
    unix = F.when(c.rlike(r"^\s*\d{10}(\d{3})?\s*$"), F.substring(F.trim(c), 1, 10).cast("bigint"))
    iso = F.nullif(F.regexp_extract(c, r"\d{4}-\d{2}-\d{2}", 0), F.lit(""))
    pattern = r"(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})"
    turned = F.concat_ws("-", F.regexp_extract(c, pattern, 3), F.lpad(F.regexp_extract(c, pattern, 2), 2, "0"), F.lpad(F.regexp_extract(c, pattern, 1), 2, "0"))
    return F.coalesce(iso, F.date_format(F.try_to_date(turned, "yyyy-MM-dd"), "yyyy-MM-dd"), F.date_format(F.timestamp_seconds(unix), "yyyy-MM-dd"))


def instant(c: Column, offset: str = "-03:00") -> Column:
    """A timestamp from ISO text; text without a zone is taken at ``offset``. Unreadable text gives null."""
    zoned = c.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.try_to_timestamp(F.when(zoned, c).otherwise(F.concat(c, F.lit(offset))))


def days_since(day: Column, as_of: str) -> Column:
    """Whole days from ``day`` to ``as_of``; negative for later days."""
    return F.datediff(F.lit(as_of).cast("date"), day)


def day_label(day: Column, as_of: str) -> Column:
    n = days_since(day, as_of)
    return F.when(n == 0, "Hoje").when(n == 1, "Ontem").when(n > 1, F.concat(n.cast("string"), F.lit(" dias"))).when(n < 0, "Futuro")


def window_label(day: Column, as_of: str, edges: tuple[int, ...] = (7, 30)) -> Column:
    """The first window of days ahead that holds the day; past days have their own label, later or missing ones 'sem janela'."""
    ahead = -days_since(day, as_of)
    out = F.when(ahead < 0, "passado")
    for e in edges:
        out = out.when(ahead <= e, f"ate {e} dias")
    return out.otherwise("sem janela")


def shown_day(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "dd/MM/yyyy"), F.lit("—"))


def cron_minutes(expression: str | None) -> list[int]:
    """Minutes of the day at which a cron expression of minutes and hours fires; none if one of the two can't be read or leaves its range.

    A field is a list of ``*``, ``n`` or ``a-b``, each with an optional ``/step``; a step behind a single number changes nothing.
    """

    def part(text: str, low: int, high: int) -> range | None:
        m = re.fullmatch(r"\s*(\*|\d+(?:-\d+)?|)\s*(?:/\s*(\d+)\s*)?", text)
        if not m or (m[2] is not None and int(m[2]) == 0):
            return None
        ends = [low, high] if m[1] in ("*", "") else [int(x) for x in m[1].split("-")]
        a, b = ends[0], ends[-1]
        return range(a, b + 1, int(m[2] or 1)) if low <= a <= b <= high else None

    def field(text: str, low: int, high: int) -> list[int]:
        parts = [part(p, low, high) for p in text.split(",") if p.strip()]
        return [] if None in parts else sorted({x for p in parts for x in p})

    fields = (expression or "").split()
    if len(fields) < 2:
        return []
    return [h * 60 + m for h in field(fields[1], 0, 23) for m in field(fields[0], 0, 59)]


def cron_label(expression: str | None, offset: int = -180) -> str:
    """How often a cron expression fires in a day, and the first four times in local time, ``offset`` minutes from UTC."""
    at = cron_minutes(expression)
    shown = [f"{m // 60:02d}:{m % 60:02d}" for m in ((x + offset) % 1440 for x in at[:4])]
    return f"{len(at)}x ao dia, às {', '.join(shown)}{', …' if len(at) > 4 else ''}" if at else "agendamento não identificado"


def shortest_gap(minutes: list[int]) -> int:
    """Least minutes between two firings, over midnight as well."""
    if len(minutes) < 2:
        return 1440
    return min([b - a for a, b in pairwise(minutes)] + [minutes[0] + 1440 - minutes[-1]])


def freshness(age_hours: Column, every_hours: float, ok: tuple[float, float] = (3, 3), late: tuple[float, float] = (8, 8)) -> Column:
    """'ok', 'atencao' or 'critico' by age against max(floor, factor * interval); a missing age calls for attention."""
    good, warn = (max(floor, factor * every_hours) for floor, factor in (ok, late))
    return F.when(age_hours.isNull(), "atencao").when(age_hours <= good, "ok").when(age_hours <= warn, "atencao").otherwise("critico")


def bucket(seconds: Column, width: int) -> Column:
    """The number of the fixed window of ``width`` seconds a Unix time falls in."""
    return F.floor(seconds / width).cast("bigint")
