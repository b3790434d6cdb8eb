"""Languages of texts and stretches, by a model trained on labels of which some are wrong."""

import random

import pytest

from civicspark.llm import languages

WORDS = {
    "pt": "o relatório da comissão aprova a proteção dos dados pessoais não houve alteração das normas para os cidadãos em questão também são informações",
    "es": "el informe de la comisión aprueba la protección de los datos personales no hubo cambios en las normas para los ciudadanos también son informaciones",
    "en": "the report of the committee approves the protection of personal data there was no change in the rules for the citizens which also shows information",
    "fr": "le rapport de la commission approuve la protection des données personnelles il n'y avait pas de changement dans les règles pour les citoyens aussi",
    "it": "la relazione della commissione approva la protezione dei dati personali non ci sono stati cambiamenti nelle regole per i cittadini anche degli altri",
    "de": "der bericht des ausschusses genehmigt den schutz der personenbezogenen daten es gab keine änderung der regeln für die bürger auch nicht zwischen",
}


def sentence(r, lang, n=10):
    w = WORDS[lang].split()
    s = " ".join(r.choice(w) for _ in range(n))
    return s[0].upper() + s[1:] + "."


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(5)
    rows, truth = [], {}
    for k in range(240):
        lang = list(WORDS)[k % 6]
        own = [sentence(r, lang) for _ in range(4)]
        if k % 20 == 7:
            other = list(WORDS)[(k + 1) % 6]
            own.insert(2, sentence(r, other))
            truth[k] = {lang, other}
        else:
            truth[k] = {lang}
        label = list(WORDS)[(k + 2) % 6] if k % 15 == 3 else {0: lang, 1: lang.upper(), 2: f"{lang}-XX"}[k % 3]
        if k % 25 == 4:
            label = [None, "", "und", "??"][k % 4]
        rows.append((k, " ".join(own), label))
    return rows, truth


EXTRA = [(900, None, "pt"), (901, "", "pt"), (902, " \n ", None), (903, "123/45 — 6", "xx"), (904, "日本語", None)]


def test_mislabelled(spark, corpus):
    rows, truth = corpus
    df = spark.createDataFrame([(*x, "p", 1.0) for x in rows + EXTRA], "doc_id bigint, text string, lang string, id string, share double")
    found = languages.document_languages(df, languages.trained(df)).cache()
    got = {(r.doc_id, r.lang) for r in languages.mislabelled(found).collect()}
    want = set()
    for k, _, label in rows:
        if not (len(truth[k]) == 1 and languages.plain_label(label) == next(iter(truth[k]))):
            want |= {(k, x) for x in truth[k]}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.03 * len(want)
    texts = {k: t for k, t, _ in rows}
    for s in languages.segments(found).collect():
        assert 0 <= s.start < s.end <= len(texts[s.doc_id]) and 0 < s.confidence <= 1
    assert {r.doc_id for r in found.collect()} == set(texts)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert languages.document_languages(df, languages.trained(df)).count() == 0


def test_labels():
    assert [languages.plain_label(x) for x in ("PT", "pt_BR", "por", " eng ", "gl", "", None)] == ["pt", "pt", "pt", "en", None, None, None]


def test_stretches():
    text = "Art. 1º O amend-\nment passes. https://x.br/y <p>The next one follows here.</p>\n\nOutra linha de texto."
    got = languages.stretches(text)
    assert got[0][0] == 0 and got[-1][1] == len(text) and all(a[1] == b[0] for a, b in zip(got, got[1:]))
    assert "amendment" in got[0][2] and not any("https" in s for _, _, s in got)
    assert languages.folded("AÇÃO ß Ñ1x") == "acao ss n x"
    assert languages.repaired("informaÃ§Ã£o") == "informação"
    assert len(languages.stretches("palavra " * 50_000)) == 1
