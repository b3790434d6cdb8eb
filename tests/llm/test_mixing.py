"""The mix keeps its caps and reaches its shares."""

import random

import pytest

from civicspark.llm import mixing

TARGETS = [("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 5)]


def run(spark, rows, targets=TARGETS, total=None):
    counts = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint, t int, salt int, rate double")
    t = spark.createDataFrame(targets, "source string, peso double, max_repeticoes int")
    m = mixing.mixed(counts, t, total=total)
    return m.collect(), {r.source: r for r in mixing.reached_shares(m, t).collect()}


def corpus():
    r = random.Random(3)
    rows = [(k, "a" if k % 3 == 0 else "b" if k % 3 == 1 else "c", int(r.lognormvariate(4, 1)) + 1) for k in range(1500)]
    rows += [(10_000 + k, "a", 77) for k in range(700)]  # a third of the rows alike
    return rows + [(90_001, None, 50), (90_002, "other", 50), (90_003, "a", 0), (90_003, "a", 0)]


def test_shares_and_caps(spark):
    docs, shares = run(spark, [(*x, 1, 2, 0.5) for x in corpus()])
    assert len(docs) == len(corpus())
    caps = {s: c for s, _, c in TARGETS}
    for d in docs:
        assert 0 <= d.copies <= caps.get(d.source, 0)
        assert d.copies == 0 or d.n_tokens > 0
    for s, want, _ in TARGETS:
        assert abs(shares[s].share - want) < 0.004
    assert shares["other"].tokens_mix == 0 and shares[None].tokens_mix == 0


def test_binding_source_is_used_up(spark):
    docs, shares = run(spark, [(*x, 1, 2, 0.5) for x in corpus()])
    full = [s for s, _, c in TARGETS if shares[s].tokens_mix >= 0.999 * c * shares[s].tokens_corpus]
    assert len(full) == 1  # the mix is the largest that meets every share


def test_total(spark):
    _, shares = run(spark, [(*x, 1, 2, 0.5) for x in corpus()], total=20_000)
    assert abs(sum(s.tokens_mix for s in shares.values()) - 20_000) < 400


@pytest.mark.parametrize("rows, targets", [([], TARGETS), ([(1, "a", 5)], []), ([(1, "a", 5)], [("a", None, 1)]), ([(1, "zz", 5)], TARGETS)])
def test_nothing_to_mix(spark, rows, targets):
    docs, _ = run(spark, [(*x, 1, 2, 0.5) for x in rows], targets)
    assert len(docs) == len(rows) and all(d.copies == 0 for d in docs)


def test_missing_source_leaves_proportions(spark):
    rows = [(k, "a" if k % 2 else "b", 10, 1, 2, 0.5) for k in range(400)]
    _, shares = run(spark, rows)
    assert abs(shares["a"].share - 0.625) < 0.01 and shares["c"].share == 0
