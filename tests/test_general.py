"""History, orphans and snapshot changes against small cases and brute force."""

import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicspark.operators import history, orphans, snapshots
from civicspark.plans import general

SNAP = "snapshot_dia string, kind string, id string, payload string, updated_at bigint, h string, at string, new int"


def snap(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SNAP)


@pytest.mark.parametrize(
    "a, b, same",
    [
        ('{"a":1,"b":[1,2]}', ' { "b" : [1,2], "a": 1.0 } ', True),
        ('{"a":[1,2]}', '{"a":[2,1]}', False),
        ('{"a":null}', "{}", False),
        (r'{"a":"é\/"}', '{"a":"é/"}', True),
        ('{"a":{"x":1,"y":2}}', '{"a":{"y":2,"x":1}}', True),
        ('{"a":"1"}', '{"a":1}', False),
        ("nope", "nope ", True),
        ("nope", '"nope"', False),
        ('{"a":true}', '{"a":1}', False),
    ],
)
def test_json_values(spark, a, b, same):
    r = spark.createDataFrame([(a, b)], "a string, b string").select(snapshots.canonical_json(F.col("a")) == snapshots.canonical_json(F.col("b"))).first()[0]
    assert r is same


def test_snapshot_cases(spark):
    rows = [
        ("d1", "k", "same", '{"a":1}', 1), ("d2", "k", "same", '{ "a": 1 }', 9),
        ("d1", "k", "gone", "{}", 1), ("d2", "k", "new", "{}", 1),
        ("d1", "k", "older", '{"a":1}', 1), ("d2", "k", "older", '{"a":2}', 1), ("d2", "k", "older", '{"a":1}', 5),
        ("d1", None, None, None, None), ("d2", None, None, None, None),
        ("d1", "k", "null", None, 1), ("d2", "k", "null", "{}", 1),
        ("d1", "k", "tie", '{"a":1}', 1), ("d1", "k", "tie", '{"a":1}', 1), ("d2", "k", "tie", '{"a":1}', 1),
        (None, "k", "noday", "{}", 1),
        ("d2", "k", "long", json.dumps({"t": "x" * 200_000}), 1), ("d4", "k", "long", json.dumps({"t": "x" * 200_000}), 2),
    ]
    got = {tuple(r) for r in snapshots.snapshot_changes(snap(spark, rows)).collect()}
    d2 = {("d2", "k", "gone", "removed"), ("d2", "k", "new", "added"), ("d2", "k", "null", "changed"), ("d2", "k", "long", "added")}
    assert {r for r in got if r[0] == "d2"} == d2
    assert {r[3] for r in got if r[0] == "d4"} == {"removed"}  # all but "long", which is the same over the gap
    assert not any(r[2] == "long" for r in got if r[0] == "d4")


def test_snapshot_empty(spark):
    assert snapshots.snapshot_changes(snap(spark, [])).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["d1", "d2", "d3"]), st.sampled_from("ab"), st.sampled_from("xyz"), st.integers(0, 3), st.integers(0, 5)), max_size=25))
def test_snapshot_brute(spark, rows):
    rows = list({(d, k, i, u): (d, k, i, json.dumps({"v": v}), u) for d, k, i, v, u in rows}.values())
    best = {}
    for d, k, i, p, u in rows:
        if (d, k, i) not in best or best[d, k, i][1] < u:
            best[d, k, i] = (p, u)
    days, want = sorted({r[0] for r in rows}), set()
    for a, b in zip(days, days[1:]):
        for key in {x[1:] for x in best if x[0] in (a, b)}:
            old, new = best.get((a, *key)), best.get((b, *key))
            what = "added" if not old else "removed" if not new else "changed" if old[0] != new[0] else None
            if what:
                want.add((b, *key, what))
    assert {tuple(r) for r in snapshots.snapshot_changes(snap(spark, rows)).collect()} == want


def log(spark, rows):
    return spark.createDataFrame(rows, "item string, campo string, data string, timestamp_execucao timestamp, update_id bigint, anterior string, novo string, k int, dia string, inicio string")


T = datetime(2024, 1, 1)


def versions(spark, rows, starts, seen=None):
    ev = history.change_events(log(spark, [(*r, 1, "z", "z") for r in rows]))
    s = spark.createDataFrame(starts, "item string, campo string, inicio string")
    o = None if seen is None else spark.createDataFrame(seen, "item string, campo string, valor string, dia string, inicio string")
    return {tuple(r) for r in history.attribute_versions(history.attribute_points(ev, s, o)).collect()}


def test_history_cases(spark):
    rows = [
        ("a", " STATUS ", "2024-02-01", T, 1, " old ", "new"), ("a", "status", "2024-02-01", datetime(2024, 3, 1), 2, "old", " newer "),
        ("a", "status", "05/03/2024", T, 3, None, "newer"),  # says nothing new
        ("a", "status", "2024-01-15", datetime(2025, 1, 1), 4, "first", "old"),  # found late
        ("a", "status", "2024-04-01", T, 5, "x", None), ("a", "status", "nonsense", T, 6, "x", "y"), ("a", None, "2024-04-02", T, 7, "x", "y"),
        ("a", "timeline", "2024-04-02", T, 8, "x", "y"), (None, "status", "2024-04-02", T, 9, "x", "y"), ("b", "status", "2024-04-02", T, 10, "x", "y"),
    ]
    got = versions(spark, rows, [("a", "status", "2020-01-01")])
    assert got == {("a", "status", "first", "2020-01-01", "2024-01-15"), ("a", "status", "old", "2024-01-15", "2024-02-01"), ("a", "status", "newer", "2024-02-01", "")}


def test_history_observed(spark):
    seen = [("a", "status", " z ", "2024-06-01", "2020-01-01"), ("n", "status", "only", "2024-06-01", "2021-01-01"), ("o", "status", None, "2024-06-01", "2021-01-01"), ("e", "status", "q", "2024-06-01", "2022-01-01")]
    starts = [(i, "status", d) for i, _, _, _, d in seen]
    got = versions(spark, [("a", "status", "2024-02-01", T, 1, "x", "y"), ("e", "status", "2024-02-01", T, 2, "p", "q")], starts, seen)
    assert got == {
        ("a", "status", "x", "2020-01-01", "2024-02-01"), ("a", "status", "y", "2024-02-01", "2024-06-01"), ("a", "status", "z", "2024-06-01", ""),
        ("n", "status", "only", "2021-01-01", ""), ("e", "status", "p", "2022-01-01", "2024-02-01"), ("e", "status", "q", "2024-02-01", ""),
    }


def test_history_empty(spark):
    assert versions(spark, [], [("a", "status", "2020-01-01")]) == set()


def test_combined(spark):
    v = spark.createDataFrame([("i", "x", "1", "d1", "d3"), ("i", "x", "2", "d3", ""), ("i", "y", "p", "d2", ""), ("j", "y", "q", "d1", "")], "item string, campo string, valor string, valido_de string, valido_ate string")
    got = {tuple(r) for r in history.combined_history(v, ("x", "y")).collect()}
    assert got == {("i", "d1", "d2", "1", None), ("i", "d2", "d3", "1", "p"), ("i", "d3", "", "2", "p"), ("j", "d1", "", None, "q")}


def test_orphans(spark):
    d = lambda m: datetime(2024, m, 1)
    rows = spark.createDataFrame(
        [("r1", [" A ", "b", None, "", " "], d(3), "t", 1), ("r2", ["a"], d(1), "t", 1), ("r3", ["a", "A"], d(6), "t", 1), ("r4", None, d(3), "t", 1), ("r5", ["a", "zz"], None, "t", 1), ("r6", ["a"] * 50, d(7), "t", 1)],
        "id string, refs array<string>, registrado_em timestamp, tabela string, n int",
    )
    targets = spark.createDataFrame([("t", "a", d(2), d(6)), ("t", "c", None, None), ("t", None, None, None)], "tabela string, ref string, since timestamp, until timestamp")
    refs = orphans.exploded_references(rows, "t", "refs")
    for share in (2000, 1, 3):
        got = {tuple(r) for r in orphans.orphan_references(refs, targets, share).collect()}
        assert got == {("t", "2024-03", "r1", "b", 1), ("t", "2024-01", "r2", "a", 1), ("t", "2024-06", "r3", "a", 2), ("t", None, "r5", "zz", 1), ("t", "2024-07", "r6", "a", 50)}
    assert orphans.orphan_references(refs.limit(0), targets).count() == 0
    assert orphans.orphan_references(refs, targets.limit(0)).count() == refs.select("id", "ref").distinct().count()


def test_registered(spark, data):
    for name in ("p2_found", "p4_found", "p5_found"):
        df = general.QUERIES[name](spark, data)
        assert df.count() == df.distinct().count()
