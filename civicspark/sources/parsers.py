"""Raw bodies of official sources as rows: JSON listings, feeds, HTML lists and data embedded in scripts, all as column expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import absolute_url, plain_text


@dataclass(frozen=True)
class Listing:
    """Where a JSON body keeps its items, and where each field of an item may stand; of several places the first present one counts."""

    lists: tuple[str, ...]
    fields: dict[str, tuple[str, ...]] = field(default_factory=dict)


#: The shapes of the listings read here.
LISTINGS = {
    "plone": Listing(("$.items",), {"link": ("$['@id']",), "classe": ("$['@type']",), "titulo": ("$.title",), "descricao": ("$.description",), "data": ("$.effective",)}),
    "atos": Listing(("$.data",), {"link": ("$.url_ato",), "classe": ("$.tipo",), "titulo": ("$.ementa", "$.numero"), "descricao": ("$.ementa",), "data": ("$.data_publicacao",)}),
    "wordpress": Listing(("$",), {"link": ("$.link",), "classe": ("$.type",), "titulo": ("$.title.rendered", "$.title"), "descricao": ("$.excerpt.rendered",), "data": ("$.date",)}),
    "diario": Listing(("$.jsonArray", "$.itens", "$.items"), {"link": ("$.urlTitle", "$.url"), "classe": ("$.artType", "$.tipo"), "titulo": ("$.title", "$.titulo"), "descricao": ("$.content", "$.resumo"), "data": ("$.pubDate", "$.data")}),
    "ckan": Listing(("$.result.results",), {"link": ("$.url",), "classe": ("$.type",), "titulo": ("$.title",), "descricao": ("$.notes",), "data": ("$.metadata_modified",)}),
    "lista": Listing(("$.data", "$.items", "$.results", "$.itens", "$"), {"link": ("$.url", "$.link", "$.href"), "classe": ("$.type", "$.tipo"), "titulo": ("$.title", "$.titulo", "$.nome"), "descricao": ("$.description", "$.descricao", "$.ementa"), "data": ("$.date", "$.data", "$.published")}),
}

ITEM = ["link", "classe", "titulo", "descricao", "data"]


def json_items(bodies: DataFrame, body: str, listing: Listing, keep: list[str] = ()) -> DataFrame:
    """(*keep, ord, link, classe, titulo, descricao, data): one row per item, in order. Bodies that are no JSON, or have no list, give none."""
    v = F.try_parse_json(body)
    items = F.coalesce(*[F.try_variant_get(v, p, "array<variant>") for p in listing.lists])
    rows = bodies.select(*keep, F.posexplode(items).alias("ord", "item"))
    get = lambda name: F.coalesce(*[F.try_variant_get("item", p, "string") for p in listing.fields.get(name, ("$.__none",))])
    return rows.select(*keep, "ord", get("link").alias("link"), get("classe").alias("classe"), plain_text(get("titulo")).alias("titulo"), plain_text(get("descricao")).alias("descricao"), get("data").alias("data"))


def feed_items(bodies: DataFrame, body: str, keep: list[str] = ()) -> DataFrame:
    """The items of RSS and Atom feeds, with bare ampersands repaired and namespace prefixes dropped. Items that can't be read give null fields."""
    sound = F.regexp_replace(F.regexp_replace(F.col(body), r"&(?!#?\w{1,8};)", "&amp;"), r"<(/?)[A-Za-z]+:", "<$1")
    items = F.concat(F.regexp_extract_all(sound, F.lit(r"(?s)<item\b.*?</item>"), F.lit(0)), F.regexp_extract_all(sound, F.lit(r"(?s)<entry\b.*?</entry>"), F.lit(0)))
    rows = bodies.select(*keep, F.posexplode(items).alias("ord", "item"))
    inner = lambda *names: F.coalesce(*[F.nullif(F.regexp_extract("item", rf"(?s)<{n}\b[^>]*>(.*?)</{n}>", 1), F.lit("")) for n in names])
    bare = lambda c: plain_text(F.regexp_replace(c, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1"))
    link = F.coalesce(F.nullif(F.regexp_extract("item", r'<link\b[^>]*href="([^"]+)"', 1), F.lit("")), F.trim(inner("link")))
    return rows.select(
        *keep, "ord", link.alias("link"), F.lit("noticia").alias("classe"), bare(inner("title")).alias("titulo"), bare(inner("description", "summary", "content")).alias("descricao"), inner("pubDate", "updated", "date").alias("data")
    )


def html_items(bodies: DataFrame, body: str, base: str, link_pattern: str, keep: list[str] = (), most: int = 80, after: int = 1000) -> DataFrame:
    """The links of an HTML listing whose address matches, each once, with up to ``after`` characters that follow as description; the first
    ``most`` by place."""
    if not 0 <= after <= 1000:
        raise ValueError("after: 0 to 1000, the longest repetition a pattern takes")
    anchor = r"(?s)<a\b[^>]*?href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>(?=([\s\S]{0,%d}))" % after
    group = lambda k: F.regexp_extract_all(body, F.lit(anchor), F.lit(k))
    rows = bodies.select(*keep, F.posexplode(F.arrays_zip(group(1).alias("href"), group(2).alias("inner"), group(3).alias("next"))).alias("ord", "a"))
    found = rows.where(F.col("a.href").rlike(link_pattern)).select(*keep, "ord", absolute_url(base, F.col("a.href")).alias("link"), F.lit("pagina").alias("classe"), plain_text(F.col("a.inner")).alias("titulo"), plain_text(F.regexp_replace("a.next", r"(?s)<a\b.*", "")).alias("descricao"), F.regexp_extract("a.next", r"\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}", 0).alias("data"))
    first = found.groupBy(*keep, "link").agg(F.min_by(F.struct("ord", "classe", "titulo", "descricao", "data"), "ord").alias("x"))
    flat = first.select(*keep, "x.ord", "link", "x.classe", "x.titulo", "x.descricao", "x.data")
    rank = F.row_number().over(Window.partitionBy(*keep).orderBy("ord")) if keep else None
    return flat.withColumn("n", rank).where(F.col("n") <= most).drop("n") if keep else flat.orderBy("ord").limit(most)


def embedded_json(body: Column, marker: str) -> Column:
    """The JSON inside the script element whose opening tag matches ``marker``, entities resolved."""
    text = F.regexp_extract(body, rf"(?s)<script\b[^>]*{marker}[^>]*>\s*(.*?)\s*</script>", 1)
    return F.nullif(F.replace(F.replace(text, F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&")), F.lit(""))


def items_of(bodies: DataFrame, kind: str, body: str, base: str = "https://example/", pattern: str = ".", keep: list[str] = ()) -> DataFrame:
    """The items of bodies of one kind: a name of LISTINGS, 'feed', 'html' or 'script' (a 'diario' listing inside a script)."""
    if kind == "feed":
        return feed_items(bodies, body, keep)
    if kind == "html":
        return html_items(bodies, body, base, pattern, keep)
    if kind == "script":
        inner = bodies.select(*keep, embedded_json(F.col(body), "").alias(body))
        return json_items(inner, body, LISTINGS["diario"], keep)
    found = json_items(bodies, body, LISTINGS[kind], keep)
    return documents_only(found) if kind == "plone" else found


#: Item types and endings of addresses that stand for files and pictures, not for pages.
FILE_TYPES = ["Image", "File", "Folder", "Link"]
FILE_ENDINGS = r"(?i)\.(png|jpe?g|gif|svg|webp|ico)(/view)?/?$"


def documents_only(items: DataFrame) -> DataFrame:
    """The items without pictures and bare files, by type and by ending of the address; nulls stay."""
    return items.where(~F.coalesce(F.col("classe").isin(FILE_TYPES), F.lit(False)) & ~F.coalesce(F.col("link").rlike(FILE_ENDINGS), F.lit(False)))


def as_list(body: Column, path: str) -> Column:
    """An array of what JSON holds at ``path``: of its elements, or of the one value that stands there without a list; empty for null and for nothing."""
    v = F.try_parse_json(body)
    many, one = F.try_variant_get(v, path, "array<variant>"), F.try_variant_get(v, path, "variant")
    some = F.when(one.isNotNull() & ~F.is_variant_null(one), F.array(one))
    return F.coalesce(many, some, F.array().cast("array<variant>"))


#: Where the details of a matter stand in the two houses' answers, by output column.
MATTERS = {
    "camara": ("$.dados", {"codigo": "$.id", "tipo": "$.siglaTipo", "numero": "$.numero", "ano": "$.ano", "ementa": "$.ementa", "situacao": "$.statusProposicao.descricaoSituacao", "data": "$.statusProposicao.dataHora"}),
    "senado": ("$.DetalheMateria.Materia", {"codigo": "$.IdentificacaoMateria.CodigoMateria", "tipo": "$.IdentificacaoMateria.SiglaSubtipoMateria", "numero": "$.IdentificacaoMateria.NumeroMateria", "ano": "$.IdentificacaoMateria.AnoMateria", "ementa": "$.DadosBasicosMateria.EmentaMateria", "situacao": "$.SituacaoAtual.Descricao", "data": "$.DadosBasicosMateria.DataApresentacao"}),
}


def matters(bodies: DataFrame, body: str, house: str, keep: list[str] = ()) -> DataFrame:
    """(*keep, codigo, tipo, numero, ano, ementa, situacao, data): the matters in a house's answers, whether one or a list stands there."""
    root, fields = MATTERS[house]
    rows = bodies.select(*keep, F.explode(as_list(F.col(body), root)).alias("m"))
    return rows.select(*keep, *[F.try_variant_get("m", p, "string").alias(n) for n, p in fields.items()])


def all_items(bodies: DataFrame, kind: str, body: str, kinds: list[str], keep: list[str] = ()) -> DataFrame:
    """Bodies of several kinds, told apart by column ``kind``, as one table of items; without title or link an item isn't one."""
    parts = [items_of(bodies.where(F.col(kind) == k), k, body, keep=keep) for k in kinds]
    return reduce(DataFrame.unionByName, parts).where((F.coalesce("titulo", F.lit("")) != "") & (F.coalesce("link", F.lit("")) != ""))


def channel_urls(spark: SparkSession, channels: list[tuple[str, str, list[str], int]], since: str, until: str) -> DataFrame:
    """(canal, pagina, url) for channels (name, template, topics, pages); the template names {topic}, {page}, {since} and {until}."""
    c = spark.createDataFrame(channels, "canal string, modelo string, topicos array<string>, paginas int")
    rows = c.withColumn("topico", F.explode_outer("topicos")).withColumn("pagina", F.explode(F.sequence(F.lit(0), F.col("paginas") - 1)))
    url = F.col("modelo")
    for name, value in (("topic", F.replace(F.url_encode(F.coalesce("topico", F.lit(""))), F.lit("+"), F.lit("%20"))), ("page", F.col("pagina").cast("string")), ("since", F.lit(since)), ("until", F.lit(until))):
        url = F.replace(url, F.lit("{" + name + "}"), value)
    return rows.select("canal", "pagina", url.alias("url")).distinct()


def profile(bodies: DataFrame, body: str, patterns: dict[str, str]) -> DataFrame:
    """What bodies look like: length, whether they are JSON, and how often each pattern occurs."""
    n = [F.size(F.regexp_extract_all(body, F.lit(p), F.lit(0))).alias(re.sub(r"\W", "_", k)) for k, p in patterns.items()]
    return bodies.select("*", F.length(body).alias("tamanho"), F.try_parse_json(body).isNotNull().alias("json"), *n).drop(body)
