"""Spellings of names: the radius join is exact, and persons come out together."""

import random

import pytest

from civicspark.llm import names


@pytest.mark.parametrize("most, chunk, sample", [(128, 1000, 512), (3, 7, 20), (1, 5, 1)])
def test_radius_join_is_exact(spark, monkeypatch, most, chunk, sample):
    for k, v in {"MOST_PIVOTS": most, "CHUNK": chunk, "SAMPLE": sample}.items():
        monkeypatch.setattr(names, k, v)
    r = random.Random(2)
    word = lambda n: "".join(r.choice(["ba", "do", "ri", "so", "x"]) for _ in range(n))
    texts = {(word(r.randint(2, 4)), word(r.randint(0, 2))) for _ in range(160)} | {("", ""), ("a" * 500, "x"), ("a" * 499, "")}
    df = spark.createDataFrame([(b, *t) for t in texts for b in (["s", "t"] if len(t[0]) < 6 else ["s"])], "state string, family string, given string")
    got = [tuple(p) for p in names.radius_pairs(df, ["state"], 2).collect()]
    near = lambda a, b: max(names.slips(a[0], b[0], 2), names.slips(a[1], b[1], 2)) <= 2
    want = {(s, *min(a, b), *max(a, b)) for s in "st" for a in texts for b in texts if a <= b and (s == "s" or (len(a[0]) < 6 and len(b[0]) < 6)) and near(a, b)}
    assert {(s, *min(x[:2], x[2:]), *max(x[:2], x[2:])) for s, *x in ((g[0], *g[1:]) for g in got)} == want
    assert len(got) == len(want)


def test_many_slips_are_slips():
    r = random.Random(5)
    words = ["".join(r.choice("abcd") for _ in range(r.randint(0, 9))) for _ in range(300)] + ["é1", "x" * 45]
    a, b = [r.choice(words) for _ in range(3000)], [r.choice(words) for _ in range(3000)]
    assert names.many_slips(a, b).tolist() == [names.slips(x, y, 99) for x, y in zip(a, b)]
    assert names.many_slips([], []).tolist() == []


def test_pivots_are_few_and_names_seldom_copied(spark):
    r = random.Random(9)
    rows = [("s", "".join(r.choice(["ba", "do", "ri", "so", "xe", "lu", "mi", "to"]) for _ in range(8)), "ana") for _ in range(60)]
    rows += [(s, f[:3] + "q" + f[4:], g) for s, f, g in rows for _ in range(3)]
    got = names.celled(spark.createDataFrame(rows, "state string, family string, given string"), ["state"])
    assert got.where("core").count() == len(set(rows)) and got.count() < 3 * len(set(rows))
    assert got.select("cell").distinct().count() > 20


def test_common_family_name_is_split(spark):
    given = ["".join(x) for x in __import__("itertools").product("aei", "bdl", "aou", "rst", "ao")]
    places = spark.createDataFrame([(k, "PA", "z", "f", "souza", f"z{g}{g[::-1]}") for k, g in enumerate(given)], "node bigint, state string, initial string, kind string, family string, given string")
    got = {tuple(r) for r in names._met(places).collect()}
    want = {(a, b) for a in range(len(given)) for b in range(a + 1, len(given)) if names.slips(f"z{given[a]}{given[a][::-1]}", f"z{given[b]}{given[b][::-1]}", 2) <= 2}
    assert got == want and len(want) < len(given) * (len(given) - 1) / 2


@pytest.mark.parametrize("a, b, d", [("abcd", "abdc", 1), ("abcd", "abcd", 0), ("", "ab", 2), ("ca", "abc", 2), ("gatoneceira", "gstonecera", 2)])
def test_slips(a, b, d):
    assert names.slips(a, b, 5) == d


@pytest.mark.parametrize(
    "name, parts, relative",
    [
        ("dos Ramos Domaro, Leandro", ["leandro", "ramos", "domaro"], ""), ("Dep.ª  Ana\xa0Maria Souza Fº (PT-SP)", ["ana", "maria", "souza"], "filho"), ("Milo Filho, A. - MDR", ["a", "milo"], "filho"), ("JOSÉ D'ÁVILA [RJ]", ["jose", "davila"], ""),
        ("Sen.", ["sen"], ""), ("", [], ""), (None, [], ""), ("12 — 3", [], ""),
    ],
)
def test_parts(name, parts, relative):
    assert names.name_parts(name) == (parts, relative)


CASES = [
    # records, whether all are one person
    (["Bianca Gatoneceira", "BIANCA GATONECEIRA", "Gatoneceira, Bianca", "Bianca Gstoneceira", "B. Gatoneceira", "Sen. Bianca Gatoneceira [PA]"], True),
    (["Francisco Lima Rovamimini", "Chico Rovamimini", "F. Lima Rovamimini", "Rovamimini Francisco"], True),
    (["Ana Bosagamedo Filho", "Ana Bosagamedo Fº", "Bosagamedo Filho, A."], True),
    (["Ana Bosagamedo Filho", "Ana Bosagamedo"], False),
    (["Ana Bosagamedo Filho", "Ana Bosagamedo Neto"], False),
    (["Zuleica da Nunes Tereganosa", "Edmundo da Nunes Tereganosa"], False),
    (["João Larissa Pelurateira", "João Mário Pelurateira"], False),
]


@pytest.mark.parametrize("records, one", CASES)
def test_persons(spark, records, one):
    filler = [(f"f{k}", f"{g} {c} Xavu{chr(97 + k % 26)}{chr(97 + k // 26)}dini", st, "P") for k, (g, c, st) in enumerate((g, c, st) for g in ("Bianca", "Francisco", "Ana", "Zuleica", "Edmundo", "João", "Larissa", "Mário") for c in ("Lima", "Nunes") for st in ("A", "B", "C", "D", "E", "F"))]
    rows = [(f"r{k}", n, " pa " if k == 1 else "PA", "P", 1, "x") for k, n in enumerate(records)] + [(*f, 1, "x") for f in filler]
    df = spark.createDataFrame(rows + rows[:2], "id string, nome string, estado string, partido string, node int, label string")
    got = {r.id: r.person for r in names.persons(df).collect()}
    mine = {got[f"r{k}"] for k in range(len(records))}
    assert (len(mine) == 1) is one
    assert len({got[f[0]] for f in filler}) == len(filler)


def test_namesakes_and_missing_states(spark):
    rows = [("a", "Ana Bosagamedo", "PA", "X"), ("b", "Ana Bosagamedo", "SP", "Y"), ("c", "Ana Bosagamedo", None, "Y"), ("d", "Ana Bosagamedo", "", "Z"), ("e", None, "PA", "X"), ("e2", "", None, None), ("f", "Ana Bosagamedo", "pa", None)]
    df = spark.createDataFrame(rows, "id string, nome string, estado string, partido string")
    people = names.persons(df)
    got = {r.id: r.person for r in people.collect()}
    assert got["a"] == got["f"] != got["b"] and got["c"] == got["b"] and got["d"] not in (got["a"], got["b"]) and not {"e", "e2"} & set(got)
    pairs = {tuple(r) for r in names.person_pairs(people).collect()}
    assert pairs == {("a", "f"), ("b", "c")}
    assert names.persons(df.limit(0)).count() == 0


def test_distances_to_pivots_as_far_as_they_count():
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    pivots = [(word(r.randint(3, 9)), word(r.randint(0, 4))) for _ in range(30)]
    xs = [(p[0][:-1] + "z", p[1]) for p in pivots] + [(word(r.randint(0, 10)), word(r.randint(0, 5))) for _ in range(200)] + [("é" * 50, "")]
    got, rest = names.to_pivots([(xs, pivots), (xs[:3], pivots[:1])], 6)
    assert rest.shape == (3, 1)
    for i, x in enumerate(xs):
        want = [max(names.slips(x[0], p[0], 99), names.slips(x[1], p[1], 99)) for p in pivots]
        assert all(g == w if w <= 6 else g > 6 for g, w in zip(got[i].tolist(), want))
