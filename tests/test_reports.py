"""States, forms, deliveries and health by literal cases, with nulls and empty tables."""

import pytest
from pyspark.sql import functions as F

from civicspark.functions import forms, states
from civicspark.operators import delivery, health


def value(spark, column, **fields):
    names = ", ".join(f"{k} {'bigint' if isinstance(v, int) and not isinstance(v, bool) else 'double' if isinstance(v, float) else 'boolean' if isinstance(v, bool) else 'string'}" for k, v in fields.items())
    return spark.createDataFrame([tuple(fields.values())], names).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "stored, step, order, want",
    [
        ("Arquivada", "Desarquivamento", "volta", "Desarquivada — Desarquivamento (MESA): volta"), ("Arquivada", "Parecer", "x", "Arquivada"), ("Em análise", "Apensação", "Apense-se ao PL 1/2020", "Em análise"),
        ("Em análise", "Desapensação", "Desapense-se e apense-se à PL 12/2023", "Apensado ao PL 12/2023 (despacho de 2024-01-02)"), ("Apensado ao PL 12/2023", "Desapensação", "desapense-se; apense-se a PL 12/2023", "Apensado ao PL 12/2023"),
        ("Em análise", "Desapensação", "", "Desapensada — Desapensação (MESA):"), ("Aguarda sanção", "Remessa à sanção", "", "Aguarda sanção"), ("Em análise", "Sancionada", "Lei 1", "Convertida em norma — Sancionada: Lei 1"),
        ("Em análise", "Remessa à sanção", "", "Aguarda sanção presidencial"), ("Em análise", "Parecer", "aprovado", "Parecer (MESA): aprovado"), (None, "Recebimento", None, ""),
    ],
)
def test_situation(spark, stored, step, order, want):
    got = value(spark, states.situation(*[F.col(c) for c in ("stored", "step", "order", "body", "day")]), stored=stored, step=step, order=order, body="MESA", day="2024-01-02")
    assert got == want


def test_labels(spark):
    one = lambda c, **f: value(spark, c, **f)
    assert one(states.age_text(F.col("h")), h=2.34) == "2.3 h" and one(states.age_text(F.col("h")), h=48.0) == "2.0 dias" and one(states.age_text(F.col("h").cast("double")), h=None) == "—"
    assert [one(states.run_day(F.col("x")), x=x) for x in ("2024-01-02T03:04:05-03:00", "2024-01-02T03:04:05", "2024-01-02", "2024-13-02", "hoje", None)] == ["2024-01-02"] * 3 + [None] * 3
    assert one(states.guessed_principal(F.lit(None).cast("string"), F.col("s")), s="Apensado ao PL 12/2023") == "camara_pl_12_2023"
    assert one(states.first_day([F.lit("1999-01-01"), F.lit(None), F.lit("2021-02-03T10:00")], "2020-01-01", F.col("f")), f="x") == "2021-02-03"
    assert one(states.clean_title(F.col("t")), t="A (Registro incorporado)  b") == "A b" and one(states.protocol_echo(F.col("t")), t="PL 1/2024: Apresentação de Proposição") and one(states.noisy(F.col("t")), t="Pregão 3") and not one(states.noisy(F.col("t")), t=None)
    assert one(states.source_status(F.col("n"), F.lit(None).cast("int"), F.lit(True)), n=2) == "parcial" and one(states.house_status(F.col("n").cast("int"), F.lit(1)), n=None) == "falha"


def test_outbox(spark):
    rows = [(1, "pending", 0, 0, True, "ok"), (2, "retry", 12, 5, True, "falha"), (3, "sending", 1, 2000, True, "ok"), (4, "sent", 1, 0, True, None), (5, "pending", None, None, False, "ok"), (6, "pending", 0, None, True, None)]
    df = spark.createDataFrame(rows, "id int, s string, n int, d bigint, w boolean, o string")
    got = {r.id: tuple(r.x) for r in df.select("id", states.outbox_next(F.col("s"), F.col("n"), F.col("d"), F.lit(1000), F.col("w"), F.col("o")).alias("x")).collect()}
    assert got == {1: ("sent", 1, 1300), 2: ("retry", 13, 1000 + 61440), 3: ("sending", 1, 2000), 4: ("sent", 1, 0), 5: ("cancelled", None, None), 6: ("sending", 1, 1300)}


def test_forms(spark):
    df = spark.createDataFrame([(1, "A@b.co", "x"), (2, "a b@c.d", "x"), (3, None, "x"), (4, "a@b.c", "y"), (5, "a@b.c", None)], "id int, mail string, kind string")
    got = {r.id: r.erro for r in forms.checked(df, {"mail": forms.is_email(F.col("mail")), "kind": F.col("kind").isin("x")}).collect()}
    assert got == {1: None, 2: "mail", 3: "mail", 4: "kind", 5: "kind"} and forms.checked(df.limit(0), {"m": F.lit(True)}).count() == 0
    assert value(spark, forms.company_number(F.col("c")), c="12.345.678/0001-90") == "12345678000190" and value(spark, forms.company_number(F.col("c")), c="12x") is None
    assert value(spark, forms.origin(F.create_map(F.lit("page"), F.col("a"), F.lit("cta"), F.lit("a@b"), F.lit("z"), F.lit("1"))), a="/x") == {"page": "/x"}


def test_deliveries(spark):
    subs = spark.createDataFrame([("a", "imediato", 90, "k"), ("b", "semanal", 90, ""), ("c", "diario", None, None), ("d", "diario", -90000, "gone"), ("e", "anual", 0, "k"), ("f", "imediato", 1, "old")], "id string, frequencia string, last bigint, acc string")
    accounts = spark.createDataFrame([("k", "active", None, 1), ("old", "active", "2020-01-01", 1), ("off", "inactive", None, 1)], "acc string, status string, ends_on string, id int")
    assert {r.id for r in delivery.due(subs, F.lit(100)).collect()} == {"a", "d", "f"}
    assert {r.id for r in delivery.served(subs, accounts, "acc", F.lit("2024-01-01")).collect()} == {"a", "b", "c", "e"}
    new = spark.createDataFrame([("x", "1"), ("y", None), ("z", "3")], "k string, v string")
    old = spark.createDataFrame([("x", "0"), ("y", None), ("w", "9")], "k string, v string")
    assert {(r.k, r.before, r.after) for r in delivery.content_changes(old, new, ["k"], "v").collect()} == {("x", "0", "1"), ("z", None, "3")}
    assert delivery.content_changes(None, new, ["k"], "v").count() == 0
    assert {tuple(r) for r in delivery.requested(old, new.unionByName(new), "k", ["v"]).collect()} == {("x", "conflito"), ("y", "repetido"), ("z", "novo")}
    s = spark.createDataFrame([("o", 1, 5), ("o", 2, 5), ("o", 3, None), ("p", 4, None)], "o string, id int, at int")
    assert {tuple(r) for r in delivery.latest_active(s, ["o"], "id", "at").collect()} == {(1, False), (2, True), (3, False), (4, False)}
    pages = spark.createDataFrame([("a", 1, 2), ("a", 2, 1), ("a", 3, 2), (None, 1, 2), (None, 2, 2)], "k string, p int, n int")
    assert {(r.k, r.p) for r in delivery.pages_in_use(pages, "k", "p", "n", 2).collect()} == {("a", 1), ("a", 2), (None, 1), (None, 2)}


def test_health(spark):
    runs = spark.createDataFrame([("r1", "concluida", 100.0, 0, 0), ("r2", None, None, 3, None), ("r3", "parcial", 99.9, None, 2)], "run string, status string, cobertura_pct double, erros int, fontes_falha int")
    assert {(r.run, r.regra) for r in health.problems(runs, "run").collect()} == {("r2", "status"), ("r2", "cobertura"), ("r2", "erros"), ("r3", "status"), ("r3", "cobertura"), ("r3", "fontes_falha")}
    src = spark.createDataFrame([("r1", "a", "OK", 1), ("r1", "b", None, 0), ("r1", "c", "ok", None)], "run string, orgao string, status string, erros int")
    assert {(r.regra, r.gravidade) for r in health.source_problems(src, "run", "orgao").collect()} == {("fonte:a", "aviso"), ("fonte:b", "problema")}
    want = spark.createDataFrame([("a", "1"), ("b", None), ("c", "3")], "id string, url string")
    assert {tuple(r) for r in health.watched(want, spark.createDataFrame([("a", "2"), ("b", None)], "id string, url string"), "id", "url").collect()} == {("a", "divergente"), ("c", "ausente")}
    assert {tuple(r) for r in health.not_once(want.select("id"), want.unionByName(want.limit(1)).select("id"), "id").collect()} == {("a", 2)}
    assert health.unresolved(want.limit(0), "id", want, "id").count() == 0 and health.over_quota(want, "id", 1).count() == 0
