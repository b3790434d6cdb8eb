"""Parsers, the HTTP source, documents on disk and streams."""

import json

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

import pytest

from civicspark.sources import files, http_source, parsers
from civicspark.streaming import incremental


def body(spark, text):
    return spark.createDataFrame([("s", text)], "src string, corpo string")


def test_plone(spark):
    b = body(spark, json.dumps({"items_total": 2, "items": [{"@id": "https://x/a", "@type": "News Item", "title": "T <b>1</b>", "description": None, "effective": "2024-01-01"}, {"title": "x"}]}))
    r = parsers.json_items(b, "corpo", parsers.LISTINGS["plone"], ["src"]).orderBy("ord").collect()
    assert r[0].titulo == "T 1" and r[0].link == "https://x/a" and r[0].descricao == "" and r[1].link is None
    assert parsers.json_items(body(spark, "no json"), "corpo", parsers.LISTINGS["plone"]).count() == 0


def test_wordpress_and_script(spark):
    b = body(spark, json.dumps([{"link": "https://x/1", "date": "2024-01-01", "title": {"rendered": "A &amp; B"}, "excerpt": {"rendered": "<p>c</p>"}, "type": "post"}]))
    assert parsers.json_items(b, "corpo", parsers.LISTINGS["wordpress"]).first().titulo == "A & B"
    s = body(spark, '<html><script id="p" type="application/json">{"jsonArray":[{"title":"T","urlTitle":"u"}]}</script></html>')
    assert parsers.items_of(s, "script", "corpo").first().titulo == "T"


def test_feeds(spark):
    rss = "<rss><channel><item><title>A & B</title><link>https://x/1</link><description><![CDATA[<p>d</p>]]></description><pubDate>Mon</pubDate></item></channel></rss>"
    atom = '<feed><entry><title>E</title><link href="https://x/2"/><updated>2024-01-01</updated><summary>s</summary></entry></feed>'
    r = parsers.feed_items(body(spark, rss), "corpo").first()
    assert (r.titulo, r.link, r.descricao) == ("A & B", "https://x/1", "d")
    assert parsers.feed_items(body(spark, atom), "corpo").first().link == "https://x/2"


def test_html(spark):
    h = '<ul><li><a href="/n/1">Um</a> 01/02/2024 texto</li><li><a class="c" href="/n/2">Dois</a></li><li><a href="/n/1">Um</a></li><li><a href="/x">Outro</a></li></ul>'
    r = parsers.html_items(body(spark, h), "corpo", "https://h.br/", "/n/").orderBy("ord").collect()
    assert [(x.link, x.titulo, x.data) for x in r] == [("https://h.br/n/1", "Um", "01/02/2024"), ("https://h.br/n/2", "Dois", "")]


def test_channels(spark):
    r = parsers.channel_urls(spark, [("c", "https://x?q={topic}&p={page}&de={since}", ["a b", "c"], 2), ("d", "https://y", [], 1)], "2024-01-01", "2024-02-01")
    assert {x.url for x in r.collect()} == {f"https://x?q={t}&p={p}&de=2024-01-01" for t in ("a%20b", "c") for p in (0, 1)} | {"https://y"}


def test_http_source(spark, tmp_path):
    (tmp_path / "ok.json").write_text("{}")
    spark.dataSource.register(http_source.HttpBodies)
    urls = [f"file://{tmp_path}/ok.json", *[f"file://{tmp_path}/no{k}" for k in range(4)]]
    r = spark.read.format("http_bodies").option("urls", json.dumps(urls)).option("pause", "0").option("breaker", "2").load().collect()
    assert [x.corpo for x in r if x.corpo] == ["{}"] and sum(x.erro == "circuito aberto" for x in r) == 2 and len(r) == 5


def test_http_cache(tmp_path):
    url, body = f"file://{tmp_path}/a.json", tmp_path / "a.json"

    def read(**o):
        reader = http_source.HttpReader({"urls": json.dumps([url]), "pause": "0"} | o)
        return [tuple(x)[:5] for p in reader.partitions() for x in reader.read(p)]

    cache = f"{tmp_path}/cache"
    assert read(cache=cache)[0][3] is not None  # an error is not kept
    body.write_text("1")
    assert read(cache=cache) == [(url, 200, "1", None, 1)]
    body.write_text("2")
    assert read(cache=cache) == [(url, 200, "1", None, 0)]
    assert read(cache=cache, fresh="-1")[0][2] == "2" and read()[0][4] == 1


def test_documents(spark, tmp_path):
    s = StructType([StructField("id", StringType())])
    (tmp_path / "d.json").write_text('{"meta": {}, "linhas": [{"id": "a"}, {"id": "b"}]}')
    (tmp_path / "bad.json").write_text("{nope")
    assert files.collection(spark, f"{tmp_path}/d.json", "linhas", s).count() == 2
    assert files.collection(spark, f"{tmp_path}/bad.json", "linhas", s).count() == 0
    assert files.collection(spark, f"{tmp_path}/none.json", "linhas", s).count() == 0
    p = f"{tmp_path}/t"
    files.publish(spark.range(3), p, (f"{tmp_path}/mirror",))
    files.publish(spark.range(5), p)
    assert files.current(spark, p).count() == 5 and spark.read.parquet(f"{tmp_path}/mirror").count() == 3


def test_upsert_stream(spark, tmp_path):
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    for k in range(3):
        spark.createDataFrame([("a", k), (f"b{k}", k)], "id string, v int").coalesce(1).write.mode("append").parquet(src)
    q = incremental.upsert_stream(incremental.parquet_stream(spark, src), out, ["id"], "v")
    q.awaitTermination()
    got = {tuple(x) for x in incremental.upserted(spark, out).select("id", "v").collect()}
    assert got == {("a", 2), ("b0", 0), ("b1", 1), ("b2", 2)}
    assert len(list((tmp_path / "out").glob("upsert_bucket=*/upsert_part=*"))) <= 6  # only what a batch touches is written


def test_matters_of_two_houses(spark):
    one = '{"DetalheMateria": {"Materia": {"IdentificacaoMateria": {"CodigoMateria": "9", "SiglaSubtipoMateria": "PL", "NumeroMateria": "12", "AnoMateria": "2023"}, "DadosBasicosMateria": {"EmentaMateria": "x", "DataApresentacao": "2023-01-02"}}}}'
    got = parsers.matters(body(spark, one), "corpo", "senado").first()
    assert (got.codigo, got.tipo, got.numero, got.ano, got.situacao) == ("9", "PL", "12", "2023", None)
    many = '{"dados": [{"id": 1, "siglaTipo": "PL", "statusProposicao": {"descricaoSituacao": "s"}}, {"id": 2}]}'
    assert [(r.codigo, r.tipo, r.situacao) for r in parsers.matters(body(spark, many), "corpo", "camara").collect()] == [("1", "PL", "s"), ("2", None, None)]
    for nothing in ('{"dados": null}', "{}", "no json", None):
        assert parsers.matters(body(spark, nothing), "corpo", "camara").count() == 0


def test_pictures_are_no_items(spark):
    rows = '{"items": [{"@id": "https://x/a.PNG", "title": "a"}, {"@id": "https://x/b", "@type": "Image", "title": "b"}, {"@id": "https://x/c", "@type": "Document", "title": "c"}, {"title": "d"}]}'
    assert [r.titulo for r in parsers.items_of(body(spark, rows), "plone", "corpo").collect()] == ["c", "d"]
    with pytest.raises(ValueError):
        parsers.html_items(body(spark, "x"), "corpo", "https://x/", ".", after=1200)


def test_parser_profile(spark):
    r = parsers.profile(body(spark, '{"a": "x", "b": "x"}'), "corpo", {"x": "x"}).first()
    assert r.json and r.x == 2


def test_default_item(spark):
    b = body(spark, '{"itens": [{"titulo": "t", "link": "l"}, {"titulo": "", "link": "l"}]}').withColumn("k", F.lit("lista"))
    assert parsers.all_items(b, "k", "corpo", ["lista"], ["src"]).count() == 1
