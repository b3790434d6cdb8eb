"""Joins and graph walks beyond plain equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def not_known(rows: DataFrame, known: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows without a partner among the known ones; nulls match nulls."""
    cond = F.lit(True)
    right = known.select(*[F.col(k).alias(f"__{k}") for k in keys.values()]).distinct()
    for a, b in keys.items():
        cond = cond & F.col(a).eqNullSafe(F.col(f"__{b}"))
    return rows.join(right, cond, "left_anti")


def sharing(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_set: str, right_set: str, wild: object = None) -> DataFrame:
    """(left_id, right_id, comuns): pairs whose sets share an element, found by an equi-join on elements instead of all pairs.

    An element ``wild`` on the left matches every right row as well; comuns counts elements that are in both sets. Null sets share nothing.
    """
    a = left.select(F.col(left_id).alias("__l"), F.explode(F.array_distinct(left_set)).alias("__e"))
    b = right.select(F.col(right_id).alias("__r"), F.explode(F.array_distinct(right_set)).alias("__e"), F.lit(1).alias("__n"))
    if wild is not None:
        b = b.unionByName(right.select(F.col(right_id).alias("__r"), F.lit(wild).alias("__e"), F.lit(0).alias("__n")))
    pairs = a.join(b, "__e").groupBy("__l", "__r").agg(F.sum("__n").alias("comuns"))
    return pairs.select(F.col("__l").alias(left_id), F.col("__r").alias(right_id), "comuns")


def last_before(rows: DataFrame, by: str, order: list[Column | str], value: Column, when: Column, out: str) -> DataFrame:
    """Rows with the value of the latest earlier row (or itself) of the group for which ``when`` holds."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.last(F.when(when, value), ignorenulls=True).over(w))


def _ends(edge: DataFrame) -> DataFrame:
    """(id, to, n, over) of (id, next): the end of each chain and the steps to it; where it runs into a circle, over is false."""
    now = edge.select("id", F.coalesce("next", "id").alias("to"), F.col("next").isNotNull().cast("bigint").alias("n"), F.col("next").isNull().alias("over"))
    left = None
    while True:
        on = now.select(F.col("id").alias("to"), F.col("to").alias("to2"), F.col("n").alias("n2"), F.col("over").alias("over2"))
        now = written(now.join(on, "to").select("id", F.col("to2").alias("to"), (F.col("n") + F.col("n2")).alias("n"), F.col("over2").alias("over")), "chains")
        going = now.where(~F.col("over")).count()
        if going in (0, left):  # while a chain that ends goes on, each round brings one more to its end
            return now
        left = going


def _circles(edge: DataFrame) -> DataFrame:
    """(id, next, length) of the circles of (id, next), in which each node has a next one."""
    now, size = edge.select("id", F.col("next").alias("to")), None
    while True:
        on = now.select(F.col("id").alias("to"), F.col("to").alias("to2"))
        now = written(now.join(on, "to").select("id", F.col("to2").alias("to")), "chains")
        reached = now.select("to").distinct().count()
        if reached == size:  # what is reached gets no less: circles only
            break
        size = reached
    own = written(edge.join(now.select(F.col("to").alias("id")).distinct(), "id", "left_semi"), "circles")
    low = own.select("id", F.col("next").alias("to"), F.least("id", "next").alias("low"))
    while True:
        on = low.select(F.col("id").alias("to"), F.col("to").alias("to2"), F.col("low").alias("low2"))
        step = low.join(on, "to").select("id", F.col("to2").alias("to"), F.least("low", "low2").alias("low"), (F.col("low2") < F.col("low")).alias("moved"))
        step = written(step, "chains")
        if step.where("moved").isEmpty():
            break
        low = step.drop("moved")
    length = step.groupBy("low").agg(F.count(F.lit(1)).alias("length"))
    return own.join(step.select("id", "low").join(length, "low").select("id", "length"), "id")


def principals(nodes: DataFrame, id: str, parent: str) -> DataFrame:
    """(id, principal, passos): the end of each node's chain of parents. A parent that is unknown or the node itself ends the chain.

    The chain doubles its step in each round, by a join of each node's pointer with the pointers of the same round, so a chain of n steps
    takes log2(n) joins; it ends when nothing moves, whatever n. Nodes whose chain runs into a circle stop before the first node they
    would visit again: the one before themselves on their circle, or before the one at which they reach it.
    """
    known = nodes.select(F.col(id).alias("id"), F.col(parent).alias("parent"))
    valid = known.join(known.select(F.col("id").alias("parent")), "parent", "left_semi").where("id <> parent")
    edge = written(known.select("id").distinct().join(valid.select("id", F.col("parent").alias("next")).distinct(), "id", "left"), "edges")
    ends = _ends(edge.where("id IS NOT NULL"))
    found = ends.where("over").select("id", "to", "n").unionByName(edge.where("id IS NULL").select("id", F.col("id").alias("to"), F.lit(0).cast("bigint").alias("n")))
    round_ = ends.where(~F.col("over")).select("id")
    if not round_.isEmpty():
        ring = written(edge.join(round_, "id", "left_semi"), "edges")
        circles = written(_circles(ring), "circles")
        enter = ring.join(circles.select("id", F.lit(True).alias("on")), "id", "left").select("id", F.when(F.col("on").isNull(), F.col("next")).alias("next"))
        before = circles.select(F.col("next").alias("to"), F.col("id").alias("stop"), "length")
        met = _ends(enter).join(before, "to").select("id", F.col("stop").alias("to"), (F.col("n") + F.col("length") - 1).alias("n"))
        found = found.unionByName(met)
    return found.select(F.col("id").alias(id), F.col("to").alias("principal"), F.col("n").alias("passos"))


def matching(subs: DataFrame, changes: DataFrame) -> DataFrame:
    """(sub_id, change_id) of changes a subscription asks for.

    subs: (sub_id, since, least, themes, orgs); changes: (change_id, at, score, theme, org). Empty lists ask for everything. The
    subscriptions with themes meet the changes by theme, those with sources only by source. Those that ask for everything meet all changes from a day on, which is their result:
    different (since, least) are few, so changes meet these first, and only what matches is handed to the subscriptions behind them.
    """
    c, s = F.col("at") >= F.col("since"), F.coalesce(F.col("score"), F.lit(-1)) >= F.col("least")
    org = (F.size("orgs") == 0) | F.array_contains("orgs", F.col("org"))
    by_theme = subs.where(F.size("themes") > 0).withColumn("theme", F.explode(F.array_distinct("themes"))).join(changes, "theme").where(c & s & org)
    by_org = subs.where((F.size("themes") == 0) & (F.size("orgs") > 0)).withColumn("org", F.explode(F.array_distinct("orgs"))).join(changes, "org").where(c & s)
    free = subs.where((F.size("themes") == 0) & (F.size("orgs") == 0))
    wants = F.array_sort(F.collect_set(F.struct("since", "least")))
    one = free.agg(wants.alias("wants")).withColumn("k", F.lit(1))  # one row of the different wishes
    asked = changes.withColumn("k", F.lit(1)).join(one, "k").select("change_id", F.explode(F.filter("wants", lambda w: (F.col("at") >= w["since"]) & (F.coalesce("score", F.lit(-1)) >= w["least"]))).alias("w"))
    any_theme = asked.select("change_id", "w.since", "w.least").join(free.select("sub_id", "since", "least"), ["since", "least"])
    parts = [by_theme, by_org, any_theme]
    return parts[0].select("sub_id", "change_id").unionByName(parts[1].select("sub_id", "change_id")).unionByName(parts[2].select("sub_id", "change_id")).distinct()
