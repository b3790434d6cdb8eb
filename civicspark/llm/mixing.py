"""Mixing sources to target weights of tokens by entropy balancing."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

#: Parts into which documents of one source and length are split, so that no such group is one task's work.
SALTS = 32

#: Starting remainders tried for the rounding of a source; the one that comes closest to its tokens is taken.
STARTS = 32

#: Newton steps at most, and the relative error of a source's tokens at which they end.
STEPS, CLOSE = 60, 1e-9


def _feasible_total(sizes: dict[str, int], targets: dict[str, tuple[float, int]]) -> float:
    """The most tokens a mix can have with all shares met and no document above its cap."""
    return min(cap * sizes[s] / share for s, (share, cap) in targets.items() if share > 0)


def balanced_rates(lengths: DataFrame, sizes: dict[str, int], targets: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, float]:
    """The tilt of each source: the solution of the convex dual of the entropy balancing problem.

    A document of t tokens gets the rate min(cap, exp(tilt * t / 1000)), the distribution nearest in relative entropy to
    "every document once" among those that give its source ``share * total`` tokens. lengths: (source, t, n) over the corpus; each
    Newton step sums the dual's slope and curvature over it, distributed, and brings back one row per source of the
    targets. Sources do not share documents, so the Hessian is diagonal. Steps that leave the known bracket halve it. A
    source that needs all its copies gets the tilt inf (every document at its cap).
    """
    total = total if total is not None else _feasible_total(sizes, targets)
    need = {s: share * total for s, (share, _) in targets.items()}
    tilt = {s: math.inf if need[s] >= targets[s][1] * sizes[s] * (1 - 1e-12) else 0.0 for s in targets}
    low, high = dict.fromkeys(targets, -math.inf), dict.fromkeys(targets, math.inf)
    open_ = {s for s in targets if math.isfinite(tilt[s])}
    spark = lengths.sparkSession
    for _ in range(STEPS):
        if not open_:
            break
        now = spark.createDataFrame([(s, tilt[s], float(targets[s][1])) for s in sorted(open_)], "source string, tilt double, cap double")
        raw = F.exp(F.least(F.col("tilt") * F.col("t") / 1000, F.lit(700.0)))
        free = raw < F.col("cap")
        sums = (
            lengths.join(F.broadcast(now), "source")  # a row per source of the targets
            .groupBy("source")
            .agg(
                F.sum(F.col("n") * F.col("t") * F.least(raw, F.col("cap"))).alias("got"),
                F.sum(F.when(free, F.col("n") * F.col("t") * F.col("t") / 1000 * raw).otherwise(0.0)).alias("slope"),
            )
            .collect()
        )
        for r in sums:
            s, over = r.source, r.got - need[r.source]
            if abs(over) <= CLOSE * need[s]:
                open_.discard(s)
                continue
            if over > 0:
                high[s] = min(high[s], tilt[s])
            else:
                low[s] = max(low[s], tilt[s])
            to = tilt[s] - over / r.slope if r.slope > 0 else math.nan
            if not low[s] < to < high[s]:
                if math.isfinite(low[s]) and math.isfinite(high[s]):
                    to = (low[s] + high[s]) / 2
                else:
                    to = high[s] - max(1.0, 2 * abs(high[s])) if math.isfinite(high[s]) else low[s] + max(1.0, 2 * abs(low[s]))
            tilt[s] = to
    return tilt


def mixed(counts: DataFrame, targets: DataFrame, id: str = "doc_id", total: float | None = None) -> DataFrame:
    """(id, source, n_tokens, copies): how often each document occurs in the mix.

    counts: (id, source, n_tokens), read several times, so a written table. targets: (source, peso, max_repeticoes), a small fixed table: it is
    collected. ``total`` is the size of the mix in tokens; None takes the largest that meets every share under the caps.

    Rates are rounded by carrying the remainder along the documents of a source in order of length, from the start that comes
    closest, so the tokens of a source are right up to less than one document, and no document goes above its cap. Sums run over groups (source, length, salt);
    which documents of a group are rounded up is decided by the order of a hash of their id, inside a group.

    Documents without tokens, with a null source or one outside the targets get 0 copies. Targets without a token in the corpus
    can't be met: the other shares keep their proportions. Rows of one id count as documents of their own. An empty table, or
    targets without any weight, gives no copies.
    """
    asked = {r.source: (float(r.peso or 0), int(r.max_repeticoes or 0)) for r in targets.select("source", "peso", "max_repeticoes").collect() if r.source is not None}
    docs = counts.select(
        F.col(id).alias("id"), "source", F.col("n_tokens").alias("t"), F.pmod(F.xxhash64(F.col(id), F.lit(7)), F.lit(SALTS)).alias("salt")
    )
    inside = docs.where(F.col("source").isin(list(asked)) & (F.col("t") > 0)) if asked else docs.limit(0)
    lengths = checkpointed(inside.groupBy("source", "t", "salt").agg(F.count(F.lit(1)).alias("n")))
    sizes = {r.source: int(r.tokens) for r in lengths.groupBy("source").agg(F.sum(F.col("n") * F.col("t")).alias("tokens")).collect()}
    usable = {s: a for s, a in asked.items() if a[0] > 0 and a[1] > 0 and sizes.get(s)}
    spark = counts.sparkSession
    if not usable:
        return counts.select(id, "source", "n_tokens", F.lit(0).alias("copies"))
    whole = sum(a for a, _ in usable.values())
    usable = {s: (a / whole, cap) for s, (a, cap) in usable.items()}
    by_length = lengths.groupBy("source", "t").agg(F.sum("n").alias("n"))
    tilt = balanced_rates(by_length, sizes, usable, total)
    solved = spark.createDataFrame(
        [(s, None if math.isinf(tilt[s]) else tilt[s], float(cap)) for s, (_, cap) in usable.items()], "source string, tilt double, cap double"
    )
    rate = F.coalesce(F.least(F.exp(F.least(F.col("tilt") * F.col("t") / 1000, F.lit(700.0))), F.col("cap")), F.col("cap"))
    rated = lengths.join(F.broadcast(solved), "source").withColumn("rate", rate)
    rated = rated.withColumn("whole", F.floor("rate").cast("int")).withColumn("part", (F.col("rate") - F.floor("rate")) * F.col("n"))
    along = Window.partitionBy("source").orderBy("t", "salt")  # one row per length and salt, not per document
    sums = rated.withColumn("upto", F.sum("part").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    sums = checkpointed(sums.withColumn("before", F.col("upto") - F.col("part")))
    up = lambda start: F.floor(F.col("upto") + start - 1e-9) - F.floor(F.col("before") + start - 1e-9)
    starts = [k / STARTS for k in range(STARTS)]
    got = sums.groupBy("source").agg(
        F.sum(F.col("t") * F.col("n") * F.col("rate")).alias("need"),
        *[F.sum(F.col("t") * (F.col("n") * F.col("whole") + up(F.lit(x)))).alias(f"got{k}") for k, x in enumerate(starts)],
    )
    best = [(r.source, min((abs(r[f"got{k}"] - r.need), x) for k, x in enumerate(starts))[1]) for r in got.collect()]
    groups = sums.join(F.broadcast(spark.createDataFrame(best, "source string, start double")), "source").withColumn("up", up(F.col("start")))
    order = Window.partitionBy("source", "t", "salt").orderBy(F.xxhash64("id"), "id")
    placed = docs.join(groups.select("source", "t", "salt", "whole", "up"), ["source", "t", "salt"], "left")
    copies = F.when(F.col("whole").isNull(), 0).otherwise(F.col("whole") + (F.row_number().over(order) <= F.col("up")).cast("int"))
    return placed.select(F.col("id").alias(id), "source", F.col("t").alias("n_tokens"), copies.alias("copies"))


def reached_shares(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, peso, max_repeticoes, documents, tokens_corpus, tokens_mix, share, most_copies) for every source of the targets or the corpus."""
    got = mix.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("n_tokens").alias("tokens_corpus"),
        F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens_mix"),
        F.max("copies").alias("most_copies"),
    )
    got = got.withColumn("all", F.sum("tokens_mix").over(Window.partitionBy()))  # a row per source
    both = got.join(F.broadcast(targets.select("source", "peso", "max_repeticoes")), "source", "full")  # the small targets
    return both.select(
        "source", "peso", "max_repeticoes", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("tokens_corpus", F.lit(0)).alias("tokens_corpus"),
        F.coalesce("tokens_mix", F.lit(0)).alias("tokens_mix"), F.coalesce(F.try_divide("tokens_mix", "all"), F.lit(0.0)).alias("share"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
    )

