"""Subscriptions, deliveries and requests: what is due, what was delivered, what comes a second time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Seconds between two deliveries by how often they are wanted.
EVERY = {"imediato": 0, "diario": 86400, "semanal": 604800}


def due(subs: DataFrame, now: Column, often: str = "frequencia", last: str = "last") -> DataFrame:
    """The subscriptions whose interval has passed at ``now`` (epoch seconds) since ``last``; one never served has waited no time, and unknown intervals are never due."""
    interval = F.create_map(*[F.lit(x) for kv in EVERY.items() for x in kv])[F.col(often)]
    return subs.where(now - F.coalesce(F.col(last), now) >= interval)


def served(subs: DataFrame, accounts: DataFrame, account: str, day: Column) -> DataFrame:
    """The subscriptions without an account, or whose account (account, status, ends_on) is known, not inactive and not past its end."""
    a = accounts.select(F.col(account).alias("__a"), F.col("status").alias("__s"), F.col("ends_on").alias("__e"))
    joined = subs.join(a, F.col(account) == F.col("__a"), "left")
    open_ = F.col("__a").isNotNull() & (F.col("__s") != "inactive") & F.coalesce(F.col("__e") >= day, F.lit(True))
    return joined.where(F.coalesce(F.col(account).cast("string"), F.lit("")).isin("") | open_).drop("__a", "__s", "__e")


def undelivered(matched: DataFrame, delivered: DataFrame, keys: list[str]) -> DataFrame:
    """The matches that were not delivered yet."""
    return matched.join(delivered.select(*keys).distinct(), keys, "left_anti")


def content_changes(old: DataFrame | None, new: DataFrame, key: list[str], value: str) -> DataFrame:
    """(*key, before, after, change_id): what is new or differs in ``new``, under an id made of key and both states, so that finding it again gives the same id.

    Without an old state nothing comes out: the first one is the baseline. Values compare null-safe; what is gone gives no row.
    """
    if old is None:
        return new.select(*key, F.lit(None).cast("string").alias("before"), F.col(value).alias("after"), F.lit("").alias("change_id")).limit(0)
    before = old.select(*key, F.col(value).alias("before"), F.lit(True).alias("__had"))
    both = new.select(*key, F.col(value).alias("after")).join(before, key, "left").where(F.col("__had").isNull() | ~F.col("before").eqNullSafe(F.col("after")))
    mark = F.concat_ws("|", *[F.col(k) for k in key], F.coalesce("before", F.lit("")), F.coalesce("after", F.lit("")))
    return both.select(*key, "before", "after", F.sha2(mark, 256).alias("change_id"))


def requested(known: DataFrame, new: DataFrame, key: str, content: list[str]) -> DataFrame:
    """(key, resultado): 'novo' for a request id not seen, 'repetido' where its content is that of the one known, 'conflito' where it is another. Repeats of one delivery count once."""
    mark = F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    have = known.select(F.col(key), mark.alias("__old")).distinct()
    return new.select(F.col(key), mark.alias("__new")).distinct().join(have, key, "left").select(
        key, F.when(F.col("__old").isNull(), "novo").when(F.col("__old") == F.col("__new"), "repetido").otherwise("conflito").alias("resultado")
    )


def latest_active(subs: DataFrame, owner: list[str], id: str, confirmed: str) -> DataFrame:
    """(id, active): of the confirmed subscriptions of one owner only the one confirmed last stays active (the greater id of two at once)."""
    best = subs.where(F.col(confirmed).isNotNull()).groupBy(*owner).agg(F.max(F.struct(F.col(confirmed), F.col(id))).alias("__b")).select(F.col(f"__b.{id}").alias("__i"))
    return subs.join(best, F.col(id) == F.col("__i"), "left").select(id, F.col("__i").isNotNull().alias("active"))


def late_facts(facts: DataFrame, at: Column, last_run: Column) -> DataFrame:
    """The facts with ``tardio``: whether they happened on or before the day of the run before; they are taken in all the same."""
    return facts.withColumn("tardio", F.coalesce(at <= last_run, F.lit(False)))


def pages_in_use(pages: DataFrame, by: str, page: str, items: str, full: int) -> DataFrame:
    """The pages of a paged scan up to and with the first one that is short; later ones are not asked for."""
    last = pages.where(F.col(items) < full).groupBy(F.col(by).alias("__b")).agg(F.min(page).alias("__p"))
    return pages.join(last, F.col(by).eqNullSafe(F.col("__b")), "left").where(F.coalesce(F.col(page) <= F.col("__p"), F.lit(True))).drop("__b", "__p")
