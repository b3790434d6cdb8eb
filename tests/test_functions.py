"""Column functions against literal expectations."""

import datetime
import unicodedata

import pytest
from pyspark.sql import functions as F

from civicspark.functions import dates, rules, text
from civicspark.operators import keyed, measures, quality, relations


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize("s", ["Sançãoß Ñ—", "ÀÉÎÕÜ ç", "nº 5ª", "", None, "日本", "a b", "x" * 100_000])
def test_fold(spark, s):
    want = unicodedata.normalize("NFKD", s or "").encode("ascii", "ignore").decode().lower()
    assert one(spark, s, text.fold) == want


def test_text(spark):
    assert one(spark, "<p>a &amp;lt; b</p>\n c&nbsp;d", text.plain_text) == "a &lt; b c d"
    assert one(spark, None, text.plain_text) == ""
    assert one(spark, " HTTPS://www.Ex.br/a/b/?q=1#z ", text.canonical_url) == "ex.br/a/b"
    assert one(spark, "Ação: Nº 5 — Fim!", text.slug) == "acao-no-5-fim"
    assert one(spark, "abcdefgh", lambda c: text.shortened(c, 5)) == "abcd…"
    assert one(spark, "abc", lambda c: text.shortened(c, 5)) == "abc"
    assert one(spark, "a<b>&\"", text.escaped) == "a&lt;b&gt;&amp;&quot;"
    assert one(spark, "https://h.x/a/123/b/c?q", text.endpoint_label) == "a/{id}/b"
    assert one(spark, 1234567.5, lambda c: text.thousands(c, 1), "double") == "1.234.567,5"
    assert one(spark, "/x/y", lambda c: text.absolute_url("https://h.br/p/q", c)) == "https://h.br/x/y"
    assert one(spark, "y", lambda c: text.absolute_url("https://h.br/p/q", c)) == "https://h.br/p/y"
    assert one(spark, None, lambda c: text.text_hash(c, F.lit("B"))) == one(spark, "", lambda c: text.text_hash(c, F.lit("b")))


def test_official(spark):
    ok = lambda u: one(spark, u, lambda c: text.official(c, ["gov.br"]))
    assert ok("https://a.gov.br/x") and ok("https://gov.br") and not ok("http://gov.br") and not ok("https://xgov.br") and not ok("https://gov.br.evil.com") and not ok(None)


def test_dates(spark):
    assert one(spark, "em 05/03/2024 às", dates.any_day) == "2024-03-05"
    assert one(spark, "31/02/2024", dates.any_day) is None
    assert one(spark, "2024-02-30T10", dates.valid_day) is None
    assert one(spark, "2024-02-29T10", dates.valid_day) == datetime.date(2024, 2, 29)
    assert one(spark, "2024-01-02T10:00:00", dates.instant) == datetime.datetime(2024, 1, 2, 13)
    assert one(spark, "2024-01-02T10:00:00Z", dates.instant) == datetime.datetime(2024, 1, 2, 10)
    assert one(spark, 23.0, lambda c: dates.freshness(c, 1), "double") == "critico"
    assert one(spark, None, lambda c: dates.freshness(c, 1), "double") == "atencao"
    assert dates.cron_minutes("17 * * * *")[:2] == [17, 77] and dates.shortest_gap(dates.cron_minutes("17 * * * *")) == 60
    assert dates.shortest_gap(dates.cron_minutes("0 9,21 * * *")) == 720 and dates.shortest_gap([5]) == 1440


def test_freshness_never_improves(spark):
    rows = spark.createDataFrame([(x / 10,) for x in range(400)], "x double").select("x", dates.freshness(F.col("x"), 1).alias("s")).orderBy("x").collect()
    rank = [["ok", "atencao", "critico"].index(r.s) for r in rows]
    assert rank == sorted(rank)


def test_rules(spark):
    assert one(spark, "Revogação do veto", lambda c: rules.first_match(c, [("veto", "v"), ("revoga", "r")])) == "v"
    assert one(spark, None, lambda c: rules.first_match(c, [("veto", "v")], "d")) == "d"
    assert one(spark, "saúde e crédito", lambda c: rules.tags(c, [(20, ["credito"]), (9, ["saude", "hospital"])])) == [9, 20]
    assert one(spark, 95, lambda c: rules.band(c, [(40, "m"), (90, "c")], "b"), "int") == "c"
    assert one(spark, 3, lambda c: rules.backoff(c), "int") == 480 and one(spark, 99, lambda c: rules.backoff(c), "int") == 61440
    assert one(spark, 7, lambda c: rules.capped_score({"a": (c, 5), "b": (F.lit(None).cast("int"), 9)}), "int") == 5


def test_keyed(spark):
    r = spark.createDataFrame([("g", 1, "2024-01-01"), ("g", 2, "2024-01-02"), ("g", 3, None), ("h", 4, "2020-01-01")], "g string, id int, d string")
    kept = keyed.retained(r, "g", [F.coalesce("d", F.lit("")).desc(), F.col("id")], 1, F.coalesce(F.col("d") >= "2024-01-02", F.lit(False)))
    assert {x.id for x in kept.collect()} == {2, 4}
    assert keyed.retained(r.limit(0), "g", [F.col("id")], 1, F.lit(False)).count() == 0
    up = keyed.upsert(r, r.withColumn("d", F.lit("new")).limit(1), ["id"], "id")
    assert {(x.id, x.d) for x in up.collect()} == {(1, "new"), (2, "2024-01-02"), (3, None), (4, "2020-01-01")}
    n = spark.createDataFrame([(None, 9), (5, 9)], "id int, v int")
    assert keyed.insert_absent(n, n.union(spark.createDataFrame([(6, 1)], "id int, v int")), ["id"]).count() == 3
    s = keyed.suffixed(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k int, base string"), "base", ["k"])
    assert {x.slug for x in s.collect()} == {"a", "a-2", "b"}


def test_state_twice_is_once(spark):
    state = spark.createDataFrame([], "k string, hash string, first_seen string, last_seen string, history array<struct<at:string,old:string,new:string>>")
    batch = lambda h, t: spark.createDataFrame([("a", h, t)], "k string, h string, t string")
    s1 = keyed.merged_state(state, batch("1", "d1"), "k", "h", "t")
    s2 = keyed.merged_state(s1, batch("2", "d2"), "k", "h", "t")
    s3 = keyed.merged_state(s2, batch("2", "d2"), "k", "h", "t")
    assert s2.collect() == s3.collect() and s3.first().first_seen == "d1" and len(s3.first().history) == 1


def test_relations(spark):
    a = spark.createDataFrame([("p", [1, 2, 2]), ("q", None), ("r", [])], "id string, cats array<int>")
    b = spark.createDataFrame([("s", [2, 3]), ("t", [9])], "s string, cats array<int>")
    assert {tuple(x) for x in relations.sharing(a, b, "id", "s", "cats", "cats").collect()} == {("p", "s", 1)}
    assert {(x.id, x.s) for x in relations.sharing(a, b, "id", "s", "cats", "cats", wild=1).collect()} == {("p", "s"), ("p", "t")}
    g = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", None), ("x", "y"), ("y", "x"), ("s", "s"), ("u", "gone")], "id string, pai string")
    got = {x.id: x.principal for x in relations.principals(g, "id", "pai").collect()}
    assert got == {"a": "c", "b": "c", "c": "c", "x": "y", "y": "x", "s": "s", "u": "u"}


def test_long_chains(spark):
    up = {k: k - 1 for k in range(1, 101)} | {0: None}  # a chain of 100 steps
    up |= {200 + k: 200 + (k + 1) % 40 for k in range(40)} | {300: 205, **{k: k - 1 for k in range(301, 340)}}  # a circle of 40 with a tail of 40
    up |= {400: 401, 401: 402, 402: 400, 403: 400}
    got = {x.id: (x.principal, x.passos) for x in relations.principals(spark.createDataFrame(list(up.items()), "id int, pai int"), "id", "pai").collect()}
    want = {}
    for k in up:
        seen = [k]
        while up[seen[-1]] is not None and up[seen[-1]] not in seen:
            seen.append(up[seen[-1]])
        want[k] = (seen[-1], len(seen) - 1)
    assert got == want


def test_measures(spark):
    e = spark.createDataFrame([("a", "2024-01-02")], "g string, d string")
    grid = measures.calendar_grid(e, F.col("d"), "2024-01-01", "2024-01-03").orderBy("dia").collect()
    assert [(r.n, r.intensidade) for r in grid] == [(0, 0.0), (1, 1.0), (0, 0.0)]
    s = spark.createDataFrame([("r", "ok"), ("r", "falha"), ("q", "ok")], "r string, s string")
    assert {tuple(x) for x in measures.overall(s, ["r"], "s").collect()} == {("r", "PARCIAL"), ("q", "OK")}


def test_quality(spark):
    r = spark.createDataFrame([(1, "a", "http://x"), (1, " ", "ftp"), (2, None, None)], "k int, n string, u string")
    rules_ = quality.required(["n"]) | {"url": ("aviso", ~F.col("u").rlike("^https?://"))}
    rep = quality.report([quality.broken(r, "t", "k", rules_), quality.repeated(r, "t", ["k"])])
    assert {(x.regra, x.n) for x in rep.collect()} == {("ausente:n", 2), ("url", 1), ("repetido", 1)}


def test_entities_like_the_library(spark):
    import html

    texts = ["&lt;b&gt; &amp;lt; &amp;amp;", "&ccedil;&Ccedil;&hellip;&mdash;&euro;", "&#39;&#233;&#x1F600;&#8212;", "sem nada", "", "a & b &; &x &unknown; &amp", "&&amp;&", "x&nbsp;y"]
    got = [r.t for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, s string").orderBy("k").select(text.unescaped(F.col("s")).alias("t")).collect()]
    for t, g in zip(texts, got):
        assert g == (html.unescape(t).replace("\xa0", " ") if "&amp" != t[-4:] else "a & b &; &x &unknown; &amp"), t
    assert spark.range(1).select(text.unescaped(F.lit("&#55296; &#0; &#9999999;")).alias("t")).first().t == "&#55296; &#0; &#9999999;"
    assert spark.range(1).select(text.unescaped(F.lit(None).cast("string")).alias("t")).first().t is None


def test_cron_fields():
    assert dates.cron_minutes("5/10 3 * * *") == [185] and dates.cron_minutes("*/30 0-1 * * *") == [0, 30, 60, 90]
    assert all(dates.cron_minutes(x) == [] for x in ("61 * * * *", "a * * * *", "*/0 * * * *", "5-1 * * * *", "5", "", None))
    assert dates.cron_label("17 9,21 * * *") == "2x ao dia, às 06:17, 18:17" and dates.cron_label("x y") == "agendamento não identificado"


def test_unix_days(spark):
    got = spark.createDataFrame([("1704067200",), ("1704067200000",), ("170406720",), (None,)], "d string").select(dates.any_day(F.col("d")).alias("x")).collect()
    assert [r.x for r in got] == ["2024-01-01", "2024-01-01", None, None]
