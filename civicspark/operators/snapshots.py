"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def canonical_json(text: Column) -> Column:
    """One spelling per JSON value.

    Objects come out with sorted keys, without spacing and with escapes resolved; lists keep their order and a
    null field stays different from an absent one. Numbers are written as decimals without trailing zeros where the
    parser keeps them exact. Text that isn't JSON (or repeats a key in one object) stands for itself, trimmed.
    """
    plain = F.trim(text)
    return F.coalesce(F.concat(F.lit("j"), F.to_json(F.try_parse_json(plain))), F.concat(F.lit("t"), plain))


def snapshot_changes(
    snapshots: DataFrame,
    day: str = "snapshot_dia",
    key: tuple[str, ...] = ("kind", "id"),
    version: str = "updated_at",
    payload: str = "payload",
) -> DataFrame:
    """Rows (day, *key, mudanca) for each record added, removed or changed since the snapshot before.

    Every row serves as the new side of its own day and the old side of the next one. Both sides are tagged, grouped by
    (day, key) and classified from one hash per side, in one aggregation shuffle with map-side combining; payloads never
    travel. The list of days (one row per snapshot) is the only broadcast.

    Several rows of one key in a snapshot: the greatest ``version`` counts, a null one last; of equal versions the one
    with the greatest payload hash. Null key parts form a key of their own. A null payload equals a null payload only.
    Rows without a day belong to no snapshot. The first snapshot, and an empty table, give no rows.
    """
    keys = [f"__k{i}" for i in range(len(key))]
    rows = snapshots.select(
        F.col(day).alias("__day"),
        *[F.col(k).alias(a) for k, a in zip(key, keys)],
        F.struct(F.col(version).alias("v"), F.xxhash64(canonical_json(F.col(payload))).alias("h")).alias("__s"),
    ).where(F.col("__day").isNotNull())
    order = Window.orderBy("__day")  # over one row per snapshot
    days = (
        snapshots.select(F.col(day).alias("__day"))
        .where(F.col("__day").isNotNull())
        .distinct()
        .select("__day", F.lead("__day").over(order).alias("__next"), F.lag("__day").over(order).alias("__prev"))
    )
    sides = rows.join(F.broadcast(days), "__day").select(
        *keys,
        "__s",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("__prev").isNotNull(), F.struct(F.col("__day").alias("at"), F.lit(True).alias("new"))),
                    F.when(F.col("__next").isNotNull(), F.struct(F.col("__next").alias("at"), F.lit(False).alias("new"))),
                )
            )
        ).alias("__side"),
    )
    both = sides.groupBy(F.col("__side.at").alias("__at"), *keys).agg(
        F.max(F.when(F.col("__side.new"), F.col("__s"))).alias("new"),
        F.max(F.when(~F.col("__side.new"), F.col("__s"))).alias("old"),
    )
    kind = (
        F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("new.h") != F.col("old.h"), "changed")
    )
    return both.select(F.col("__at").alias(day), *[F.col(a).alias(k) for k, a in zip(key, keys)], kind.alias("mudanca")).where(
        F.col("mudanca").isNotNull()
    )


def change_counts(changes: DataFrame, day: str = "snapshot_dia", by: tuple[str, ...] = ("kind",)) -> DataFrame:
    """Added, removed and changed records per snapshot and group."""
    one = lambda what: F.count_if(F.col("mudanca") == what).alias(what)
    return changes.groupBy(day, *by).agg(one("added"), one("removed"), one("changed"))
