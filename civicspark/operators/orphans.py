"""References to records that do not exist when the reference is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .history import trimmed

#: A key is heavy from one in this many references on; there are then at most as many heavy keys.
HEAVY_SHARE = 2000


def exploded_references(rows: DataFrame, table: str, refs: str, id: str = "id", at: str = "registrado_em") -> DataFrame:
    """(tabela, id, at, ref): one row per reference of the list column ``refs``, as lower-case text without outer blanks.

    Null and blank elements are no references; a null or empty list gives none. Repeats stay and are merged later.
    """
    return (
        rows.select(F.lit(table).alias("tabela"), F.col(id).alias("id"), F.col(at).alias("at"), F.explode(refs).alias("ref"))
        .withColumn("ref", F.lower(trimmed(F.col("ref").cast("string"))))
        .where(F.col("ref") != "")
    )


def _missing(at: Column, since: Column, until: Column, found: Column) -> Column:
    """Whether the target does not exist at ``at``; a null start means always there, a null end never removed."""
    return found.isNull() | F.coalesce(since > at, F.lit(False)) | F.coalesce(until <= at, F.lit(False))


def orphan_references(references: DataFrame, targets: DataFrame, heavy_share: int = HEAVY_SHARE) -> DataFrame:
    """(tabela, periodo, id, ref, n): the references whose target is missing, not there yet or removed, n times each.

    references: (tabela, id, at, ref) of exploded_references. targets: (tabela, ref, since, until), the life spans of the
    records by referring table; several spans of one target are allowed, and one that holds ``at`` is enough.

    References are first counted per key and period. Keys that hold one in ``heavy_share`` references or more, at most
    ``heavy_share`` of them whatever the input, are checked against their own targets by broadcast; the others meet the
    targets in a shuffled join, free of hot keys. Both parts are united. A target with many spans only widens its own
    key. A reference with null ``at`` has a null periodo and is an orphan only if no such target exists at all. Empty
    inputs give no rows.
    """
    key = ["tabela", "ref"]
    counted = references.groupBy("tabela", "ref", "id", "at").agg(F.count(F.lit(1)).alias("n"))
    refs = written(counted.withColumn("periodo", F.date_format("at", "yyyy-MM")), "references")
    per_key = refs.groupBy(*key, "periodo").agg(F.sum("n").alias("n"))
    sums = written(per_key.groupBy(*key).agg(F.sum("n").alias("n")), "reference-sums")
    total = sums.agg(F.sum("n").alias("total")).first().total or 0
    heavy = sums.where(F.col("n") * heavy_share >= total).select(*key)
    spans = (
        targets.where(F.col("ref").isNotNull())
        .groupBy(*key)
        .agg(F.collect_set(F.struct("since", "until")).alias("spans"))
    )
    dead = lambda s: _missing(F.col("at"), s["since"], s["until"], F.lit(True))
    orphan = F.col("spans").isNull() | F.forall("spans", dead)
    heavy_refs = refs.join(F.broadcast(heavy), key, "left_semi")
    heavy_spans = spans.join(F.broadcast(heavy), key, "left_semi")
    rest = refs.join(F.broadcast(heavy), key, "left_anti")
    parts = [heavy_refs.join(F.broadcast(heavy_spans), key, "left"), rest.join(spans.hint("merge"), key, "left")]
    out = [p.where(orphan).select("tabela", "periodo", "id", "ref", "n") for p in parts]
    return out[0].unionByName(out[1]).groupBy("tabela", "periodo", "id", "ref").agg(F.sum("n").alias("n"))


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """(tabela, periodo, linhas, referencias, alvos): orphan references per table and period."""
    return orphans.groupBy("tabela", "periodo").agg(
        F.count_distinct("id").alias("linhas"), F.sum("n").alias("referencias"), F.count_distinct("ref").alias("alvos")
    )
