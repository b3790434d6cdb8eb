"""Counts, series, shares and health measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts_by_each(rows: DataFrame, dims: dict[str, Column]) -> DataFrame:
    """(dimensao, valor, n): one count per value of each dimension, all in one pass over the rows (grouping sets)."""
    names = list(dims)
    picked = rows.select(*[F.coalesce(c.cast("string"), F.lit("(nulo)")).alias(n) for n, c in dims.items()])
    sets = [[F.col(n)] for n in names]
    g = picked.groupingSets(sets, *[F.col(n) for n in names]).agg(F.count(F.lit(1)).alias("n"))
    which = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in names])
    return g.select(which.alias("dimensao"), F.coalesce(*names).alias("valor"), "n")


def last_periods(counts: DataFrame, period: str, n: int) -> DataFrame:
    """The ``n`` latest periods present, by a top-k."""
    return counts.orderBy(F.col(period).desc()).limit(n)


def calendar_grid(rows: DataFrame, day: Column, start: str, end: str) -> DataFrame:
    """(dia, semana, dia_semana, n, intensidade): every day of the span, with no rows as 0; intensity is 0.25 + 0.75 n / max."""
    n = rows.select(day.cast("date").alias("dia")).groupBy("dia").agg(F.count(F.lit(1)).alias("n"))
    days = rows.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("dia"))
    full = days.join(n, "dia", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    top = F.max("n").over(Window.partitionBy())  # one row per day of the span
    first = F.lit(start).cast("date")
    week = F.floor(F.datediff("dia", first) / 7).cast("bigint")
    heat = F.when(F.col("n") == 0, 0.0).otherwise(F.round(0.25 + 0.75 * F.col("n") / top, 6))
    return full.select(F.date_format("dia", "yyyy-MM-dd").alias("dia"), week.alias("semana"), F.weekday("dia").cast("bigint").alias("dia_semana"), "n", heat.alias("intensidade"))


def with_share(counts: DataFrame, n: str, by: list[str] = ()) -> DataFrame:
    """Rows with ``parte``, their share of the sum; for counts already aggregated, few rows."""
    return counts.withColumn("parte", F.round(F.col(n) / F.sum(n).over(Window.partitionBy(*by)), 6))


def period_over_period(sums: DataFrame, period: str, value: str) -> DataFrame:
    """Rows with the value of the period before and the relative change."""
    before = F.lag(value).over(Window.orderBy(period))  # one row per period
    return sums.withColumn("anterior", before).withColumn("variacao", F.when(F.col("anterior") != 0, F.round((F.col(value) - F.col("anterior")) / F.col("anterior"), 6)))


def overall(statuses: DataFrame, by: list[str], status: str) -> DataFrame:
    """(by, status_global): OK if all parts are ok, FALHA if all failed, PARCIAL otherwise."""
    ok, bad = F.bool_and(F.col(status) == "ok"), F.bool_and(F.col(status) == "falha")
    return statuses.groupBy(*by).agg(F.when(ok, "OK").when(bad, "FALHA").otherwise("PARCIAL").alias("status_global"))
