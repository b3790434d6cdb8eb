"""Operators on keyed rows: first and last wins, retention, rotation, upserts with history, transitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the first by ``order``. Nulls in a key are a key of their own."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def dedup_counts(rows: DataFrame, by: str, key: Column, kept: Column) -> DataFrame:
    """(by, consultados, mantidos, descartados, duplicados) of first_wins on ``key``: duplicates are counted before relevance.

    Aggregates per key first, so a key that repeats often is one row before groups are counted.
    """
    one = rows.select(by, key.alias("__k"), kept.alias("__kept")).groupBy(by, "__k").agg(F.count(F.lit(1)).alias("n"), F.max("__kept").alias("kept"))
    return one.groupBy(by).agg(
        F.sum("n").alias("consultados"), F.count_if("kept").alias("mantidos"), F.count_if(~F.col("kept")).alias("descartados"), F.sum(F.col("n") - 1).alias("duplicados")
    )


def retained(rows: DataFrame, group: str, order: list[Column], newest: int, recent: Column) -> DataFrame:
    """Rows that are among the ``newest`` of their group, or recent.

    The rank limit is pushed into the window, so a task keeps at most ``newest`` rows of a group before the shuffle; recent rows are read once more and
    pass by the filter alone.
    """
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    top = rows.withColumn("__n", rank).where(F.col("__n") <= newest).withColumn("__top", F.lit(True)).drop("__n")
    return top.where(~F.coalesce(recent, F.lit(False))).drop("__top").unionByName(rows.where(recent))


def rotated(rows: DataFrame, key: str, order: list[Column], live: int) -> DataFrame:
    """Rows with ``destino``: 'vivo' for the first ``live`` by order, 'arquivo' for the rest.

    ``key`` is unique; ``live`` is a small number. The live rows are found by a top-k, of which each task sends ``live`` at most, instead of
    ranking all rows in one task; the rest is what an anti join on the key leaves.
    """
    first = rows.orderBy(*order).limit(live)
    rest = rows.join(first.select(key), key, "left_anti").select(*rows.columns)
    return first.withColumn("destino", F.lit("vivo")).unionByName(rest.withColumn("destino", F.lit("arquivo")))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Old and new rows, one per key: the greatest version; of equal versions the new row."""
    both = old.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    return first_wins(both, keys, [F.col(version).desc_nulls_last(), F.col("__side").desc()]).drop("__side")


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows and those new ones whose key is not there yet; null keys match null keys."""
    cond = F.lit(True)
    known = old.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return old.unionByName(new.join(known, cond, "left_anti"), allowMissingColumns=True)


def field_changes(old: DataFrame, new: DataFrame, key: str, fields: list[str], only_known: bool = True) -> DataFrame:
    """(key, campo, anterior, novo): a row per field that differs between two states of a record, in one join.

    With ``only_known`` a field that had no value before gives no change. Records on one side only give none.
    """
    side = lambda d, p: d.select(F.col(key), *[F.col(f).cast("string").alias(f"{p}{f}") for f in fields])
    both = side(new, "n_").join(side(old, "o_"), key)
    had = lambda f: F.col(f"o_{f}").isNotNull() if only_known else F.lit(True)
    one = [
        F.when(had(f) & ~F.col(f"o_{f}").eqNullSafe(F.col(f"n_{f}")), F.struct(F.lit(f).alias("campo"), F.col(f"o_{f}").alias("anterior"), F.col(f"n_{f}").alias("novo")))
        for f in fields
    ]
    return both.select(key, F.explode(F.array_compact(F.array(*one))).alias("c")).select(key, "c.*")


def merged_state(state: DataFrame, batch: DataFrame, key: str, hash_: str, seen: str, most: int = 20) -> DataFrame:
    """State after a batch: first sight kept, last sight moved, and the hash before added to the history where it changed.

    state: (key, hash, first_seen, last_seen, history array<struct<at,old,new>>); batch: (key, hash, seen), one row per key.
    """
    b = batch.select(F.col(key).alias("__k"), F.col(hash_).alias("__h"), F.col(seen).alias("__t"))
    j = state.join(b, F.col(key) == F.col("__k"), "full")
    changed = F.col(key).isNotNull() & F.col("__k").isNotNull() & (F.col("__h") != F.col("hash"))
    entry = F.array(F.struct(F.col("__t").alias("at"), F.col("hash").alias("old"), F.col("__h").alias("new")))
    history = F.when(changed, F.slice(F.concat(entry, F.col("history")), 1, most)).otherwise(F.coalesce("history", F.array().cast("array<struct<at:string,old:string,new:string>>")))
    return j.select(
        F.coalesce(key, "__k").alias(key), F.coalesce("__h", "hash").alias("hash"), F.coalesce("first_seen", "__t").alias("first_seen"),
        F.greatest("last_seen", "__t").alias("last_seen"), history.alias("history"),
    )


def suffixed(rows: DataFrame, base: str, order: list[Column | str], out: str = "slug") -> DataFrame:
    """Unique names: the first row of a base keeps it, later ones get -2, -3 and so on."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(*order))
    return rows.withColumn("__n", n).withColumn(out, F.when(F.col("__n") == 1, F.col(base)).otherwise(F.concat(base, F.lit("-"), F.col("__n").cast("string")))).drop("__n")


def within_rate(rows: DataFrame, keys: list[str], at: Column, width: int, most: int, order: list[Column | str]) -> DataFrame:
    """Rows with ``permitido``: whether fewer than ``most`` of the same key came before in the same window of ``width`` seconds."""
    slot = F.floor(at / width).cast("bigint")
    w = Window.partitionBy(*keys, "janela").orderBy(*order)
    return rows.withColumn("janela", slot).withColumn("permitido", F.row_number().over(w) <= most)
