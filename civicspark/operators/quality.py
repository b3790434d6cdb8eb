"""Data-quality checks: each gives rows (regra, gravidade, tabela, chave) for what breaks it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def broken(rows: DataFrame, table: str, key: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """Rows that break any of the rules {name: (severity, condition of breaking)}, all checked in one pass. Null conditions are not broken."""
    hits = [F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(n).alias("regra"), F.lit(s).alias("gravidade"))) for n, (s, c) in rules.items()]
    found = rows.select(F.col(key).cast("string").alias("chave"), F.explode(F.array_compact(F.array(*hits))).alias("r"))
    return found.select("r.regra", "r.gravidade", F.lit(table).alias("tabela"), "chave")


def required(fields: list[str]) -> dict[str, tuple[str, Column]]:
    return {f"ausente:{f}": ("erro", F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == "")) for f in fields}


def repeated(rows: DataFrame, table: str, keys: list[str], rule: str = "repetido") -> DataFrame:
    joined = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    n = rows.groupBy(joined.alias("chave")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return n.select(F.lit(rule).alias("regra"), F.lit("erro").alias("gravidade"), F.lit(table).alias("tabela"), "chave")


def dangling(rows: DataFrame, table: str, ref: str, targets: DataFrame, target: str) -> DataFrame:
    """Keys that refer to nothing, each once; the references are made distinct before the join, so no key is hot."""
    refs = rows.select(F.col(ref).cast("string").alias("chave")).where("chave IS NOT NULL").distinct()
    miss = refs.join(targets.select(F.col(target).cast("string").alias("chave")).distinct(), "chave", "left_anti")
    return miss.select(F.lit(f"sem alvo:{ref}").alias("regra"), F.lit("aviso").alias("gravidade"), F.lit(table).alias("tabela"), "chave")


def report(parts: list[DataFrame]) -> DataFrame:
    """(tabela, regra, gravidade, n) over all checks."""
    return reduce(DataFrame.unionByName, parts).groupBy("tabela", "regra", "gravidade").agg(F.count(F.lit(1)).alias("n"))
