"""Health of collection runs and of published pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def problems(runs: DataFrame, run: str) -> DataFrame:
    """(run, regra, gravidade): what makes a run unfit, a row each. runs: (run, status, cobertura_pct, erros, fontes_falha); a null share is a problem, null counts are none."""
    rules = {
        "status": ~F.coalesce(F.col("status") == "concluida", F.lit(False)), "cobertura": ~F.coalesce(F.col("cobertura_pct") >= 100, F.lit(False)),
        "erros": F.coalesce(F.col("erros"), F.lit(0)) > 0, "fontes_falha": F.coalesce(F.col("fontes_falha"), F.lit(0)) > 0,
    }
    hit = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return runs.select(run, F.explode(hit).alias("regra"), F.lit("problema").alias("gravidade"))


def source_problems(sources: DataFrame, run: str, source: str) -> DataFrame:
    """(run, regra, gravidade): sources that are not 'ok' are problems, those that are and still had errors are warnings."""
    bad = F.lower(F.coalesce("status", F.lit(""))) != "ok"
    level = F.when(bad, "problema").when(F.coalesce("erros", F.lit(0)) > 0, "aviso")
    return sources.select(run, F.concat(F.lit("fonte:"), F.col(source)).alias("regra"), level.alias("gravidade")).where("gravidade IS NOT NULL")


def watched(wanted: DataFrame, rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, problema): the wanted records that are missing ('ausente') or have another value ('divergente'); of several rows of one key each is looked at."""
    held = rows.select(F.col(key), F.col(value).alias("__v"), F.lit(True).alias("__there"))
    both = wanted.join(held, key, "left")
    return both.select(key, F.when(F.col("__there").isNull(), "ausente").when(~F.col("__v").eqNullSafe(F.col(value)), "divergente").alias("problema")).where("problema IS NOT NULL").distinct()


def over_quota(rows: DataFrame, day: str, most: int) -> DataFrame:
    """(day, n): the days with more rows than allowed."""
    return rows.groupBy(day).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)


def unresolved(rows: DataFrame, link: str, pages: DataFrame, page: str) -> DataFrame:
    """(link, n): links to pages that don't exist, with how often each stands; counted before the join, so that a link that stands everywhere is one row."""
    n = rows.where(F.col(link).isNotNull()).groupBy(link).agg(F.count(F.lit(1)).alias("n"))
    return n.join(pages.select(F.col(page).alias(link)).distinct(), link, "left_anti")


def not_once(keys: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """(key, linhas): the keys that don't have exactly one row."""
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return keys.join(n, key, "left").select(key, F.coalesce("__n", F.lit(0)).alias("linhas")).where("linhas <> 1")
