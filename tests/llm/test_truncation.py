"""Cut values by their end, by the words before it and by the lengths of their source."""

import random

import pytest

from civicspark.llm import truncation

SUBJ = ["o comitê", "a agência", "o relator", "a comissão"]
VERB = ["aprova", "rejeita", "revisa", "suspende"]
OBJ = ["o uso de dados", "a guarda de registros", "o teste de modelos", "a verificação de idade"]
END = ["nas operações de crédito", "para fins estatísticos", "em processos judiciais", "nos serviços de saúde"]


def text(r, n):
    out = []
    for _ in range(n):
        s = f"{r.choice(SUBJ)} {r.choice(VERB)} {r.choice(OBJ)} {r.choice(END)}"
        out.append(s[0].upper() + s[1:])
    return ". ".join(out)


@pytest.mark.parametrize(
    "value, sign",
    [
        ("Texto completo.", None), ("Texto completo", None), ("O voto [...]", "ellipsis"), ("O voto…", "ellipsis"), ("O voto...", "ellipsis"), ("Ele disse \"vamos ver…\"", None), ("Fim. (ver o item 3...)", None),
        ("A [...] b. Fim.", None), ("Texto com <br", "markup"), ("Texto com </", "markup"), ("conte&ccedi", "entity"), ("informaç�", "bytes"), ("Em caráter (processo 12", "open"), ("Disse \"vamos", "open"),
        ("Fim. Leia mais: https://x.br/n/1", None), ("<p>Fim.</p>", None), ("a) primeiro item", None), ("Texto corta… · Gabinete", "ellipsis"), (" ", None), ("x" * 300_000, None),
        ('O texto "abre aspas e não fecha. Fim parcial.', "open"), ("A lei (art. 5 diz que tudo. O resto.", "open"), ("<p>Um parágrafo <b>forte. Mais texto.", "open"), ("<p>Um <b>forte</b>.<br>Fim.", None), ("a [b (c] d. Fim.", None),
        ("Conforme o art.", "short"), ("Texto longo [...].", "ellipsis"), ("Texto longo (continua).", "ellipsis"), ("(" * 50_000 + ")" * 50_000 + ".", None), ("a < b & c > d.", None),
    ],
)
def test_signs(value, sign):
    assert truncation.read_end(value)[1] == sign


def test_the_automaton_keeps_what_is_open():
    assert truncation.unclosed('<div>"a (b [c] d" (e <i>f') == ["<div", "(", "<i"]
    assert truncation.unclosed("b) c] &amp; <br/> <p>x") == []


def rows():
    r = random.Random(9)
    out, cut = [], set()
    for k in range(3000):
        t = text(r, 2 + k % 3)
        if k % 10 == 3:
            t = t[: len(t) - r.randint(4, 30)]
            if t.rstrip().endswith(tuple(e.split()[-1] for e in END)):
                t = t.rstrip()[:-1]
            cut.add(k)
            if k % 20 == 3:
                t += " · Gabinete"
        elif k % 5:
            t += "."
        elif k % 15 == 0:
            t += " (anexo único)"
        out.append((k, f"s{k % 3}", f"Edital {k} — {r.choice(OBJ)} {r.choice(END)}", t))
    return out, cut


def test_words(spark):
    data, cut = rows()
    df = spark.createDataFrame([(*x, 1, True) for x in data], "registro bigint, orgao string, titulo string, descricao string, n int, ended boolean")
    got = truncation.truncated(df)
    found = {r.id for r in got.where("sign IS NOT NULL AND campo = 'descricao'").collect()}
    assert len(found & cut) >= 0.95 * len(cut) and len(found - cut) <= 0.02 * len(cut)
    assert got.where("sign IS NOT NULL AND campo = 'titulo'").count() <= 2
    shares = {(r.orgao, r.campo): r for r in truncation.truncation_shares(got).collect()}
    assert sum(r.valores for r in shares.values()) == 6000 and abs(shares["s0", "descricao"].parte - 0.1) < 0.03


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, None), (1, None, None, None), (2, "s", "", "…"), (3, None, "Título", "Fim.")], "registro bigint, orgao string, titulo string, descricao string")
    got = truncation.truncated(df).collect()
    assert {(r.id, r.campo) for r in got} == {(3, "titulo"), (3, "descricao")} and not any(r.sign for r in got if r.campo == "descricao")
    assert truncation.truncated(df.limit(0)).count() == 0


def test_baselines(spark):
    base = [(k, "s", "d", 80 + k % 60, False, None, False, True) for k in range(240)] + [(k, "s", "d", 100, False, None, False, True) for k in range(1000, 1040)] + [(k, "s", "d", 100, False, "words", False, True) for k in range(2000, 2040)]
    base += [(3000, "s", "d", 100, False, None, False, False)]  # something was put behind it
    base += [(4000 + k, "t", "d", 200 + k % 50, True, None, False, True) for k in range(100)] + [(5000, "t", "d", 222, False, None, True, True)]
    base += [(6000 + k, "u", "d", 200 + k % 50, True, None, True, True) for k in range(100)] + [(7000, "u", "d", 222, False, None, True, True)]
    df = spark.createDataFrame(base, "id bigint, source string, campo string, n int, ended boolean, sign string, blank boolean, bare boolean")
    got = truncation.with_baselines(df)
    limit = got.where("sign = 'limit'").collect()
    assert {r.n for r in limit} == {100} and not any(r.id == 3000 for r in limit) and got.count() == len(base)
    assert {r.id for r in got.where("sign = 'blank'").collect()} == {5000}
