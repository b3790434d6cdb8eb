"""History of changing attributes, built from a change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Changes of these fields record happenings, not values of an attribute.
HAPPENINGS = ("timeline",)

#: White space in a character class, the Unicode kinds included.
SPACES = r"\s\u00a0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"


def trimmed(c: Column) -> Column:
    """Without outer white space of any kind; null stays null."""
    return F.regexp_replace(c, f"^[{SPACES}]+|[{SPACES}]+$", "")


def iso_day(c: Column) -> Column:
    """``YYYY-MM-DD`` from that form (a time may follow) or ``dd/mm/yyyy``; null for anything else."""
    t = trimmed(c)
    turned = F.regexp_replace(t, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$2-$1")
    return F.date_format(F.try_to_date(F.regexp_extract(turned, r"^\d{4}-\d{1,2}-\d{1,2}", 0), "yyyy-M-d"), "yyyy-MM-dd")


def change_events(log: DataFrame) -> DataFrame:
    """(item, campo, dia, seq, anterior, novo) of the attribute changes in a log like ``updates``.

    ``seq`` orders the changes of one day: time of the run, then update_id. Rows without a readable day, without an item or
    with a field that is null, blank or a happening are left out. A new value that is null or blank is read as null.
    """
    blank = lambda c: F.nullif(trimmed(F.col(c)), F.lit(""))
    return log.select(
        "item",
        F.lower(trimmed(F.col("campo"))).alias("campo"),
        iso_day(F.col("data")).alias("dia"),
        F.struct(F.col("timestamp_execucao").alias("t"), F.col("update_id").alias("u")).alias("seq"),
        blank("anterior").alias("anterior"),
        blank("novo").alias("novo"),
    ).where(F.col("item").isNotNull() & F.col("dia").isNotNull() & (F.col("campo") != "") & ~F.col("campo").isin(*HAPPENINGS))


def attribute_points(events: DataFrame, starts: DataFrame, observed: DataFrame | None = None) -> DataFrame:
    """(item, campo, dia, valor): per attribute, the days from which a value holds.

    events: of change_events. starts: (item, campo, inicio), the first day of each attribute; only these attributes count. observed: (item, campo,
    valor, dia, inicio), a value seen on a day outside the log; it adds a last version where it differs from the last
    logged one, or is the only version (from inicio on) of an attribute without changes.

    The log is first reduced to one row per attribute and day, with map-side combining, so an item that holds a third of
    the log shrinks to as many rows as it has days; only then are attributes ordered in windows. Of several changes on one day the
    greatest ``seq`` holds. The first version has the earlier value of the earliest change; if that is null it starts with the
    change. Changes to the value already held, or to null, make no version.
    """
    daily = events.groupBy("item", "campo", "dia").agg(
        F.max(F.struct("seq", "novo")).alias("last"), F.min(F.struct("seq", "anterior")).alias("first")
    )
    daily = daily.select("item", "campo", "dia", F.col("last.novo").alias("novo"), F.col("first.anterior").alias("anterior"))
    marks = daily.join(starts.select("item", "campo", "inicio"), ["item", "campo"]).withColumn("seen", F.lit(False))
    if observed is not None:
        seen = observed.select(
            "item", "campo", "dia", F.nullif(trimmed(F.col("valor")), F.lit("")).alias("novo"),
            F.lit(None).cast("string").alias("anterior"), F.lit(True).alias("seen"), "inicio",
        )
        marks = marks.unionByName(seen)
    order = Window.partitionBy("item", "campo").orderBy("seen", "dia")
    rows = marks.withColumn("n", F.row_number().over(order))
    first = F.col("n") == 1
    points = F.array_compact(
        F.array(
            F.when(first & F.col("seen"), F.struct(F.lit(0).alias("k"), F.col("inicio").alias("dia"), F.col("novo").alias("valor"))),
            F.when(
                first & ~F.col("seen") & F.col("anterior").isNotNull(),
                F.struct(F.lit(0).alias("k"), F.col("inicio").alias("dia"), F.col("anterior").alias("valor")),
            ),
            F.when(
                ~(first & F.col("seen")),
                F.struct((F.lit(1) + F.col("seen").cast("int")).alias("k"), F.col("dia").alias("dia"), F.col("novo").alias("valor")),
            ),
        )
    )
    flat = rows.select("item", "campo", F.explode(points).alias("p")).select("item", "campo", "p.*")
    flat = flat.where(F.col("dia").isNotNull() & F.col("valor").isNotNull())
    before = F.lag("valor").over(Window.partitionBy("item", "campo").orderBy("k", "dia"))
    return flat.withColumn("before", before).where(~F.col("before").eqNullSafe(F.col("valor"))).select("item", "campo", "dia", "valor", "k")


def attribute_versions(points: DataFrame) -> DataFrame:
    """(item, campo, valor, valido_de, valido_ate): each point valid until the next one of its attribute, the last until ''."""
    order = Window.partitionBy("item", "campo").orderBy("k", "dia")
    until = F.coalesce(F.lead("dia").over(order), F.lit(""))
    return points.select("item", "campo", "valor", F.col("dia").alias("valido_de"), until.alias("valido_ate"))


def combined_history(versions: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(item, valido_de, valido_ate, *fields): the whole record per period.

    Every item is split at the union of its attributes' boundary days; each attribute is carried forward and neighbouring periods
    that agree in all fields are coalesced. Attributes without a version there are null. Of versions of one attribute that
    start on one day the greatest value is kept.
    """
    at = versions.groupBy("item", F.col("valido_de").alias("dia")).agg(*[F.max(F.when(F.col("campo") == f, F.col("valor"))).alias(f) for f in fields])
    order = Window.partitionBy("item").orderBy("dia")
    held = at.select("item", "dia", *[F.last(f, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(f) for f in fields])
    state = F.struct(*fields)
    kept = held.withColumn("before", F.lag(state).over(order)).where(F.col("before").isNull() | ~F.col("before").eqNullSafe(state)).drop("before")
    until = F.coalesce(F.lead("dia").over(order), F.lit(""))
    return kept.select("item", F.col("dia").alias("valido_de"), until.alias("valido_ate"), *fields)
