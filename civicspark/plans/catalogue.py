"""Queries that exercise the operators on the tables of a data directory, each with the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, rules, text
from ..operators import keyed, measures, quality, relations
from ..sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: The day on which the reports are made.
AS_OF = "2026-09-15"

#: Example rules for the classifiers, on folded text.
STRONG = ["sistemas? autonomos?", "decisoes automatizadas", "treinamento de modelos", "dados de treinamento"]
WEAK = ["algoritm", "biometri", "centros de processamento"]
WEAK_ONLY = ["centros de processamento"]
THEMES = [(1, ["normas gerais", "marco"]), (2, ["direito"]), (3, ["dados pessoais", "informacoes pessoais"]), (7, ["trabalho"]), (8, ["ensino", "capacitacao"]), (9, ["saude"]), (12, ["judiciais"]), (20, ["credito"]), (24, ["transparencia", "rotulagem"]), (25, ["auditoria", "avaliacao de impacto"]), (26, ["alto risco"])]
EVENTS = [(r"\brevoga", "revogação"), (r"consulta publica", "consulta"), (r"\bdecis", "decisão"), (r"altera", "alteração"), (r"regulament", "regulamentação")]

_FOLD = "regexp_replace(replace(replace(replace(lower(strip_accents({0})),'º','o'),'ª','a'),chr(160),' '),'[^\\x00-\\x7F]','','g')"


def fold_sql(c: str) -> str:
    return _FOLD.format(f"coalesce({c},'')")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def any_sql(c: str, patterns: list[str]) -> str:
    return f"regexp_matches({c}, '{rules.any_of(patterns)}')"


# --- text and dates


@query(f"SELECT id, {fold_sql('ementa')} AS dobrado, trim(regexp_replace({fold_sql('titulo')},'\\s+',' ','g')) AS titulo FROM propositions")
def text_fold(spark, root):
    return table(spark, root, "propositions").select("id", text.fold(F.col("ementa")).alias("dobrado"), text.normalized(F.col("titulo")).alias("titulo"))


@query("SELECT p_partkey, 'sha1:' || left(sha1(trim(regexp_replace(lower(p_name || ' | ' || p_brand),'\\s+',' ','g'))),16) AS hash, 'chg_' || left(sha1(p_name || '|' || p_type || '|' || CAST(p_size AS VARCHAR)),16) AS chave FROM part")
def text_hash(spark, root):
    p = table(spark, root, "part")
    return p.select("p_partkey", text.text_hash(F.col("p_name"), F.col("p_brand")).alias("hash"), text.key_hash("chg_", F.col("p_name"), F.col("p_type"), F.col("p_size")).alias("chave"))


@query(
    "WITH a AS (SELECT id, regexp_replace(left(regexp_replace(regexp_replace(replace(replace(lower(strip_accents(nome)),'º','o'),'ª','a'),'[^a-z0-9]+','-','g'),'^-+|-+$','','g'),30),'-+$','') AS slug, nome FROM laws) "
    "SELECT DISTINCT id, slug, CASE WHEN length(nome) <= 20 THEN nome ELSE regexp_replace(left(nome,19),'[ ,;:.]+$','') || '…' END AS curto FROM a"
)
def slugify(spark, root):
    return table(spark, root, "laws").select("id", text.slug(F.col("nome"), 30).alias("slug"), text.shortened(F.col("nome"), 20).alias("curto")).distinct()


@query(
    "SELECT registro, left(trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(coalesce(descricao,''),'<[^>]+>',' ','g'),"
    "'&nbsp;',' '),'&lt;','<'),'&gt;','>'),'&quot;','\"'),'&#39;',''''),'&apos;',''''),'&ccedil;','ç'),'&atilde;','ã'),'&otilde;','õ'),'&aacute;','á'),'&eacute;','é'),'&iacute;','í'),'&oacute;','ó'),'&uacute;','ú'),'&acirc;','â'),'&ecirc;','ê'),'&ocirc;','ô'),'&agrave;','à'),'&amp;','&'),'\\s+',' ','g')),600) AS texto FROM atos"
)
def clean_html(spark, root):
    return table(spark, root, "atos").select("registro", text.plain_text(F.col("descricao")).alias("texto"))


_CANON = "regexp_replace(split_part(split_part(regexp_replace(regexp_replace(lower(trim(coalesce({0},''))),'^https?://',''),'^www\\.',''),'#',1),'?',1),'/+$','')"


@query(f"SELECT registro, {_CANON.format('url_oficial')} AS url, lower(orgao) || '_' || left(regexp_replace(regexp_replace({_CANON.format('url_oficial')},'[^a-zA-Z0-9]+','_','g'),'^_+|_+$','','g'),110) AS item FROM atos")
def canonical_url(spark, root):
    u = F.col("url_oficial")
    return table(spark, root, "atos").select("registro", text.canonical_url(u).alias("url"), text.item_id(F.lower("orgao"), u).alias("item"))


@query(
    "SELECT update_id, fonte_url LIKE 'https://%' AND (regexp_extract(coalesce(fonte_url,''),'^[a-z]+://([^/:?#]+)',1) IN ('camara.example','don.example') OR regexp_extract(coalesce(fonte_url,''),'^[a-z]+://([^/:?#]+)',1) LIKE '%.camara.example' OR regexp_extract(coalesce(fonte_url,''),'^[a-z]+://([^/:?#]+)',1) LIKE '%.don.example') AS oficial FROM updates WHERE fonte_url IS NOT NULL"
)
def url_official(spark, root):
    return table(spark, root, "updates").where("fonte_url IS NOT NULL").select("update_id", text.official(F.col("fonte_url"), ["camara.example", "don.example"]).alias("oficial"))


@query(
    "WITH l AS (SELECT registro, unnest(regexp_extract_all(coalesce(descricao,''),'https?://[^\\s<>\"]+')) AS link FROM atos) SELECT registro, link, count(*) AS n FROM l GROUP BY ALL"
)
def html_links(spark, root):
    found = F.explode(F.regexp_extract_all(F.coalesce("descricao", F.lit("")), F.lit('https?://[^\\s<>"]+'), F.lit(0)))
    return table(spark, root, "atos").select("registro", found.alias("link")).groupBy("registro", "link").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, CAST(json_extract_string(props,'$.k') AS BIGINT) AS k, coalesce(json_extract_string(props,'$.items'), json_extract_string(props,'$.k'), 'nada') AS primeiro FROM events")
def json_props(spark, root):
    get = lambda p: F.get_json_object("props", p)
    return table(spark, root, "events").select("event_id", get("$.k").cast("bigint").alias("k"), F.coalesce(get("$.items"), get("$.k"), F.lit("nada")).alias("primeiro"))


@query(
    "SELECT update_id, CASE WHEN regexp_matches(data,'\\d{4}-\\d{2}-\\d{2}') THEN regexp_extract(data,'\\d{4}-\\d{2}-\\d{2}') ELSE strftime(try_strptime(regexp_extract(data,'\\d{1,2}[/.-]\\d{1,2}[/.-]\\d{4}'),'%d/%m/%Y'),'%Y-%m-%d') END AS dia, "
    f"date_diff('day', try_cast(data_deteccao AS DATE), DATE '{AS_OF}') AS idade, CASE WHEN date_diff('day', try_cast(data_deteccao AS DATE), DATE '{AS_OF}') < 0 THEN 'Futuro' WHEN date_diff('day', try_cast(data_deteccao AS DATE), DATE '{AS_OF}') = 0 THEN 'Hoje' WHEN date_diff('day', try_cast(data_deteccao AS DATE), DATE '{AS_OF}') = 1 THEN 'Ontem' ELSE date_diff('day', try_cast(data_deteccao AS DATE), DATE '{AS_OF}') || ' dias' END AS rotulo, coalesce(strftime(try_cast(data_deteccao AS DATE),'%d/%m/%Y'),'—') AS mostrado FROM updates"
)
def date_parse(spark, root):
    d = dates.valid_day(F.col("data_deteccao"))
    return table(spark, root, "updates").select(
        "update_id", dates.any_day(F.col("data")).alias("dia"), dates.days_since(d, AS_OF).cast("bigint").alias("idade"), dates.day_label(d, AS_OF).alias("rotulo"), dates.shown_day(d).alias("mostrado")
    )


# --- classification and scoring


@query(
    f"WITH t AS (SELECT registro, {fold_sql('descricao')} AS x FROM atos) SELECT registro, CASE WHEN {any_sql('x', STRONG)} THEN 'forte' WHEN {any_sql('x', [w for w in WEAK if w not in WEAK_ONLY])} THEN 'media' WHEN {any_sql('x', WEAK_ONLY)} THEN 'infra' END AS relevancia FROM t"
)
def relevance(spark, root):
    return table(spark, root, "atos").select("registro", rules.graded(F.col("descricao"), STRONG, WEAK, WEAK_ONLY).alias("relevancia"))


@query(
    f"WITH t AS (SELECT id, {fold_sql('ementa')} AS x FROM propositions), h AS (SELECT id, list_filter([{', '.join('CASE WHEN ' + ' OR '.join(f'contains(x,{w!r})' for w in ws) + f' THEN {i} END' for i, ws in THEMES)}], lambda v: v IS NOT NULL) AS l FROM t) SELECT id, array_to_string(list_slice(list_sort(list_distinct(l)),1,6),',') AS temas FROM h"
)
def categories_infer(spark, root):
    t = rules.tags(F.col("ementa"), THEMES)
    return table(spark, root, "propositions").select("id", F.array_join(F.transform(t, lambda x: x.cast("string")), ",").alias("temas"))


@query(f"WITH t AS (SELECT update_id, {fold_sql('titulo')} || ' ' || {fold_sql('descricao')} AS x FROM updates) SELECT update_id, CASE {' '.join(f'WHEN regexp_matches(x,{p!r}) THEN {v!r}' for p, v in EVENTS)} ELSE 'publicação' END AS tipo_evento FROM t".replace("\\\\b", "\\b"))
def change_type(spark, root):
    both = F.concat(F.coalesce("titulo", F.lit("")), F.lit(" "), F.coalesce("descricao", F.lit("")))
    return table(spark, root, "updates").select("update_id", rules.first_match(both, EVENTS, "publicação").alias("tipo_evento"))


@query("SELECT CASE WHEN contains(lower(situacao),'aguardando') THEN 'espera' WHEN contains(lower(situacao),'aprovada') THEN 'aprovada' WHEN contains(lower(situacao),'arquiv') OR contains(lower(situacao),'devolvida') THEN 'encerrada' ELSE 'em_tramitacao' END AS grupo, count(*) AS n FROM propositions GROUP BY 1")
def status_group(spark, root):
    s = F.lower("situacao")
    g = F.when(s.contains("aguardando"), "espera").when(s.contains("aprovada"), "aprovada").when(s.contains("arquiv") | s.contains("devolvida"), "encerrada").otherwise("em_tramitacao")
    return table(spark, root, "propositions").groupBy(g.alias("grupo")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH l AS (SELECT l_orderkey, count(*) AS linhas, count(*) FILTER (WHERE l_returnflag='R') AS devolvidas FROM lineitem GROUP BY 1), s AS (SELECT o_orderkey, greatest(0, least(100, least(coalesce(CAST(floor(o_totalprice/10000) AS BIGINT),0),40) + least(coalesce(linhas*5,0),30) + least(coalesce(devolvidas*10,0),30))) AS score FROM orders LEFT JOIN l ON o_orderkey=l_orderkey) "
    "SELECT o_orderkey, score, CASE WHEN score>=90 THEN 'CRITICO' WHEN score>=60 THEN 'RELEVANTE' WHEN score>=40 THEN 'MONITORAR' ELSE 'BAIXA' END AS faixa FROM s"
)
def weighted_score(spark, root):
    lines = table(spark, root, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("linhas"), F.count_if(F.col("l_returnflag") == "R").alias("devolvidas"))
    o = table(spark, root, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    score = rules.capped_score({"valor": (F.floor(F.col("o_totalprice") / 10000).cast("bigint"), 40), "linhas": (F.col("linhas") * 5, 30), "devolvidas": (F.col("devolvidas") * 10, 30)})
    scored = o.select("o_orderkey", score.alias("score"))
    return scored.withColumn("faixa", rules.band(F.col("score"), [(40, "MONITORAR"), (60, "RELEVANTE"), (90, "CRITICO")], "BAIXA"))


# --- selection and order


@query(
    "SELECT o_orderkey, c_name, CAST(round(o_totalprice) AS BIGINT) AS score FROM orders JOIN customer ON o_custkey=c_custkey WHERE c_mktsegment='BUILDING' AND o_totalprice>=1000 ORDER BY score DESC, o_orderkey LIMIT 5"
)
def briefing_top5(spark, root):
    c = table(spark, root, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")
    o = table(spark, root, "orders").where("o_totalprice >= 1000").join(c, F.col("o_custkey") == F.col("c_custkey"))
    return o.select("o_orderkey", "c_name", F.round("o_totalprice").cast("bigint").alias("score")).orderBy(F.desc("score"), "o_orderkey").limit(5)


@query(
    "SELECT p.id, p.titulo FROM propositions p WHERE p.casa_atual='Senado' AND p.ano BETWEEN 2018 AND 2024 AND list_has_any(p.categorias,[3,7,20]) AND contains(lower(coalesce(p.titulo,'') || ' ' || coalesce(p.ementa,'')),'dados')"
)
def listing_filter(spark, root):
    p = table(spark, root, "propositions").where("casa_atual = 'Senado' AND ano BETWEEN 2018 AND 2024")
    wanted = F.arrays_overlap("categorias", F.array(F.lit(3), F.lit(7), F.lit(20)))
    return p.where(wanted & F.lower(F.concat(F.coalesce("titulo", F.lit("")), F.lit(" "), F.coalesce("ementa", F.lit("")))).contains("dados")).select("id", "titulo")


@query("WITH r AS (SELECT registro, orgao, data, row_number() OVER (PARTITION BY orgao ORDER BY coalesce(data,'') DESC, registro) AS n FROM atos) SELECT registro, orgao, data FROM r WHERE n<=20 OR coalesce(data >= '2026-08-01', false)")
def retention_topn(spark, root):
    a = table(spark, root, "atos").select("registro", "orgao", "data")
    return keyed.retained(a, "orgao", [F.coalesce("data", F.lit("")).desc(), F.col("registro")], 20, F.coalesce(F.col("data") >= "2026-08-01", F.lit(False)))


@query("WITH r AS (SELECT update_id, row_number() OVER (ORDER BY data_deteccao DESC NULLS LAST, update_id DESC) AS n FROM updates) SELECT CASE WHEN n<=800 THEN 'vivo' ELSE 'arquivo' END AS destino, count(*) AS n, min(update_id) AS menor FROM r GROUP BY 1")
def rotate_log(spark, root):
    u = table(spark, root, "updates").select("update_id", "data_deteccao")
    r = keyed.rotated(u, "update_id", [F.col("data_deteccao").desc_nulls_last(), F.col("update_id").desc()], 800)
    return r.groupBy("destino").agg(F.count(F.lit(1)).alias("n"), F.min("update_id").alias("menor"))


# --- joins and sets


@query("SELECT DISTINCT u.update_id, p.titulo AS ficha FROM updates u JOIN propositions p ON u.item=p.id WHERE p.ano>=2020")
def change_links(spark, root):
    p = table(spark, root, "propositions").where("ano >= 2020").select("id", F.col("titulo").alias("ficha"))
    return table(spark, root, "updates").select("update_id", "item").join(p, F.col("item") == F.col("id")).select("update_id", "ficha")


@query("SELECT event_id, user_id FROM events e WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey=e.user_id AND c.c_acctbal>0)")
def semi_changes(spark, root):
    c = table(spark, root, "customer").where("c_acctbal > 0")
    return table(spark, root, "events").join(c, F.col("user_id") == F.col("c_custkey"), "left_semi").select("event_id", "user_id")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey IS NOT DISTINCT FROM c_custkey AND o_orderpriority='1-URGENT' AND o_totalprice>250000)")
def anti_known(spark, root):
    return relations.not_known(table(spark, root, "customer").select("c_custkey"), table(spark, root, "orders").where("o_orderpriority = '1-URGENT' AND o_totalprice > 250000"), {"c_custkey": "o_custkey"})


@query(
    "WITH s AS (SELECT * FROM (VALUES ('bancos',[20,21]),('saude',[3,9]),('escolas',[8,27])) t(setor,cats)) SELECT p.id, s.setor FROM propositions p, s WHERE list_has_any(coalesce(p.categorias,[]),s.cats) OR list_contains(coalesce(p.categorias,[]),1)"
)
def theta_overlap(spark, root):
    sectors = spark.createDataFrame([("bancos", [20, 21]), ("saude", [3, 9]), ("escolas", [8, 27])], "setor string, cats array<int>")
    p = table(spark, root, "propositions").select("id", "categorias")
    return relations.sharing(p, sectors, "id", "setor", "categorias", "cats", wild=1).select("id", "setor")


@query(
    "WITH s AS (SELECT * FROM (VALUES ('s1','2026-01-01',0,['view'],['a']),('s2','2024-01-10',50,[],[]),('s3','2024-01-01',0,['click','error'],[])) t(sub_id,since,minimo,themes,orgs)), e AS (SELECT event_id, strftime(ts,'%Y-%m-%d') AS dia, CAST(floor(value) AS INT) AS score, event_type AS theme FROM events) "
    "SELECT sub_id, event_id AS change_id FROM s, e WHERE dia>=since AND score>=minimo AND (len(themes)=0 OR list_contains(themes,theme)) AND (len(orgs)=0)"
)
def subscription_match(spark, root):
    subs = spark.createDataFrame(
        [("s1", "2026-01-01", 0, ["view"], ["a"]), ("s2", "2024-01-10", 50, [], []), ("s3", "2024-01-01", 0, ["click", "error"], [])], "sub_id string, since string, least int, themes array<string>, orgs array<string>"
    )
    e = table(spark, root, "events").select(
        F.col("event_id").alias("change_id"), F.date_format("ts", "yyyy-MM-dd").alias("at"), F.floor("value").cast("int").alias("score"), F.col("event_type").alias("theme"), F.lit("x").alias("org")
    )
    return relations.matching(subs, e)


@query("SELECT event_id, last_value(CASE WHEN event_type<>'error' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ultimo_ok FROM events")
def asof_last_ok(spark, root):
    e = table(spark, root, "events").select("event_id", "user_id", "ts", "event_type")
    return relations.last_before(e, "user_id", ["ts", "event_id"], F.col("event_id"), F.col("event_type") != "error", "ultimo_ok").select("event_id", "ultimo_ok")


@query(
    "WITH RECURSIVE c(id, alvo, n) AS (SELECT p_partkey, p_partkey, 0 FROM part UNION ALL SELECT c.id, CAST(floor(c.alvo/3) AS BIGINT), c.n+1 FROM c WHERE CAST(floor(c.alvo/3) AS BIGINT) IN (SELECT p_partkey FROM part) AND CAST(floor(c.alvo/3) AS BIGINT)<>c.alvo) SELECT id AS p_partkey, arg_max(alvo,n) AS principal, CAST(max(n) AS BIGINT) AS passos FROM c GROUP BY 1"
)
def principal_chain(spark, root):
    p = table(spark, root, "part").select("p_partkey", F.floor(F.col("p_partkey") / 3).cast("bigint").alias("pai"))
    return relations.principals(p, "p_partkey", "pai")


@query(
    "SELECT 'uniao' AS conjunto, count(*) AS n FROM (SELECT user_id FROM events UNION SELECT o_custkey FROM orders) UNION ALL SELECT 'intersecao', count(*) FROM (SELECT user_id FROM events INTERSECT SELECT o_custkey FROM orders) UNION ALL SELECT 'diferenca', count(*) FROM (SELECT user_id FROM events EXCEPT SELECT o_custkey FROM orders)"
)
def union_except_intersect(spark, root):
    a, b = table(spark, root, "events").select("user_id"), table(spark, root, "orders").select(F.col("o_custkey").alias("user_id"))
    one = lambda name, d: d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("conjunto"), "n")
    return one("uniao", a.union(b).distinct()).union(one("intersecao", a.intersect(b))).union(one("diferenca", a.subtract(b)))


@query("SELECT l.id, count(DISTINCT p.id) AS propostas FROM (SELECT DISTINCT id, unnest(proposicoes_relacionadas) AS r FROM parliamentarians) l JOIN propositions p ON lower(trim(l.r))=p.id GROUP BY 1")
def author_propositions(spark, root):
    r = table(spark, root, "parliamentarians").select("id", F.explode("proposicoes_relacionadas").alias("r")).select("id", F.lower(F.trim("r")).alias("alvo")).distinct()
    return r.join(table(spark, root, "propositions").select(F.col("id").alias("alvo")), "alvo", "left_semi").groupBy("id").agg(F.count("alvo").alias("propostas"))


# --- aggregation


@query(
    "SELECT 'status' AS dimensao, o_orderstatus AS valor, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'prioridade', o_orderpriority, count(*) FROM orders GROUP BY 2 UNION ALL SELECT 'ano', CAST(year(o_orderdate) AS VARCHAR), count(*) FROM orders GROUP BY 2"
)
def band_counts(spark, root):
    return measures.counts_by_each(table(spark, root, "orders"), {"status": F.col("o_orderstatus"), "prioridade": F.col("o_orderpriority"), "ano": F.year("o_orderdate")})


@query("SELECT c.nome, count(*) AS n FROM (SELECT unnest(categorias) AS k FROM propositions) x JOIN categories c ON c.id=x.k GROUP BY 1")
def by_category(spark, root):
    x = table(spark, root, "propositions").select(F.explode("categorias").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return x.join(table(spark, root, "categories").select("id", "nome"), "id").groupBy("nome").agg(F.sum("n").alias("n"))


@query("SELECT mes, n FROM (SELECT strftime(o_orderdate,'%Y-%m') AS mes, count(*) AS n FROM orders GROUP BY 1) ORDER BY mes DESC LIMIT 12")
def changes_by_month(spark, root):
    c = table(spark, root, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("mes")).agg(F.count(F.lit(1)).alias("n"))
    return measures.last_periods(c, "mes", 12)


@query("SELECT coalesce(nullif(tipo,''),'não classificado') AS tipo, count(*) AS n FROM updates GROUP BY 1")
def changes_by_type(spark, root):
    return table(spark, root, "updates").groupBy(F.coalesce(F.nullif("tipo", F.lit("")), F.lit("não classificado")).alias("tipo")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH d AS (SELECT l_returnflag, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS k FROM lineitem JOIN orders ON l_orderkey=o_orderkey) SELECT l_returnflag, round(avg(CASE WHEN k<=30 THEN k END),6) AS media, count(*) FILTER (WHERE k>30) AS tardias FROM d GROUP BY 1"
)
def latency_stats(spark, root):
    l = table(spark, root, "lineitem").select("l_orderkey", "l_returnflag", "l_shipdate")  # noqa: E741
    j = l.join(table(spark, root, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    k = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    return j.groupBy("l_returnflag").agg(F.round(F.avg(F.when(k <= 30, k)), 6).alias("media"), F.count_if(k > 30).alias("tardias"))


@query(
    "SELECT count(*) AS total, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-24') AS dias7, count(*) FILTER (WHERE event_type='error') AS erros, count(DISTINCT user_id) AS usuarios, round(100.0*count(DISTINCT user_id)/greatest(1,(SELECT count(*) FROM customer)),1) AS cobertura FROM events"
)
def kpi_row(spark, root):
    n = table(spark, root, "customer").agg(F.count(F.lit(1)).alias("__n"))  # one row: joined on a constant, not counted while the plan is made
    k = table(spark, root, "events").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("ts") >= F.lit("2024-01-24").cast("timestamp_ntz")).alias("dias7"),
        F.count_if(F.col("event_type") == "error").alias("erros"), F.count_distinct("user_id").alias("usuarios"),
    )
    both = k.withColumn("__k", F.lit(1)).join(n.withColumn("__k", F.lit(1)), "__k")
    return both.select("total", "dias7", "erros", "usuarios", F.round(100.0 * F.col("usuarios") / F.greatest(F.lit(1), F.col("__n")), 1).alias("cobertura"))


@query(
    "WITH p AS (SELECT orgao, array_to_string(list_slice(list_transform(string_split(split_part(regexp_replace(regexp_replace(url_oficial,'^https?://[^/]*',''),'^/+|/+$','','g'),'?',1),'/'), lambda s: CASE WHEN regexp_matches(s,'^\\d+$') THEN '{id}' ELSE s END),1,2),'/') AS endpoint FROM atos) SELECT orgao, endpoint, count(*) AS chamadas FROM p GROUP BY ALL"
)
def endpoint_stats(spark, root):
    e = table(spark, root, "atos").select("orgao", text.endpoint_label(F.col("url_oficial"), 2).alias("endpoint"))
    return e.groupBy("orgao", "endpoint").agg(F.count(F.lit(1)).alias("chamadas"))


@query(
    "WITH s AS (SELECT user_id, event_type, CASE WHEN bool_and(value<30) THEN 'ok' WHEN bool_and(value>=30) THEN 'falha' ELSE 'parcial' END AS st FROM events GROUP BY 1,2) SELECT user_id, CASE WHEN bool_and(st='ok') THEN 'OK' WHEN bool_and(st='falha') THEN 'FALHA' ELSE 'PARCIAL' END AS status_global FROM s GROUP BY 1"
)
def global_status(spark, root):
    s = table(spark, root, "events").groupBy("user_id", "event_type").agg(
        F.when(F.bool_and(F.col("value") < 30), "ok").when(F.bool_and(F.col("value") >= 30), "falha").otherwise("parcial").alias("st")
    )
    return measures.overall(s, ["user_id"], "st")


@query(
    "SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS impressoes, round(sum(l_linenumber*l_quantity)/nullif(sum(l_quantity),0),6) AS posicao FROM lineitem GROUP BY 1 HAVING sum(l_quantity)>=20 AND sum(l_linenumber*l_quantity)/nullif(sum(l_quantity),0) BETWEEN 3 AND 10"
)
def weighted_position(spark, root):
    g = table(spark, root, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"), F.sum(F.col("l_linenumber") * F.col("l_quantity")).alias("w"))
    p = F.col("w") / F.nullif("q", F.lit(0.0))
    return g.where((F.col("q") >= 20) & p.between(3, 10)).select("l_suppkey", F.col("q").cast("bigint").alias("impressoes"), F.round(p, 6).alias("posicao"))


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS ultimo FROM events GROUP BY 1")
def latest_run(spark, root):
    return table(spark, root, "events").groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("ultimo"))


@query(
    "WITH n AS (SELECT CAST(ts AS DATE) AS dia, count(*) AS n FROM events GROUP BY 1), d AS (SELECT CAST(x AS DATE) AS dia FROM generate_series(TIMESTAMP '2024-01-01',TIMESTAMP '2024-02-11',INTERVAL 1 DAY) t(x)), f AS (SELECT d.dia, coalesce(n.n,0) AS n FROM d LEFT JOIN n USING (dia)) SELECT strftime(dia,'%Y-%m-%d') AS dia, CAST(floor(date_diff('day',DATE '2024-01-01',dia)/7) AS BIGINT) AS semana, isodow(dia)-1 AS dia_semana, n, CASE WHEN n=0 THEN 0.0 ELSE round(0.25+0.75*n/max(n) OVER (),6) END AS intensidade FROM f"
)
def heatmap_grid(spark, root):
    return measures.calendar_grid(table(spark, root, "events"), F.col("ts"), "2024-01-01", "2024-02-11")


@query("WITH s AS (SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1) SELECT p, n, round(n/sum(n) OVER (),6) AS parte FROM s")
def share_of_total(spark, root):
    return measures.with_share(table(spark, root, "orders").groupBy(F.col("o_orderpriority").alias("p")).agg(F.count(F.lit(1)).alias("n")), "n")


@query(
    "WITH s AS (SELECT strftime(o_orderdate,'%Y-%m') AS mes, count(*) AS n FROM orders GROUP BY 1) SELECT mes, n, lag(n) OVER (ORDER BY mes) AS anterior, CASE WHEN lag(n) OVER (ORDER BY mes)<>0 THEN round((n-lag(n) OVER (ORDER BY mes))/lag(n) OVER (ORDER BY mes),6) END AS variacao FROM s"
)
def period_over_period(spark, root):
    s = table(spark, root, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("mes")).agg(F.count(F.lit(1)).alias("n"))
    return measures.period_over_period(s, "mes", "n")


# --- keyed rows


@query(
    "WITH k AS (SELECT orgao, lower(titulo) AS k, count(*) AS n, bool_or(relevancia='forte') AS kept FROM atos GROUP BY 1,2) SELECT orgao, CAST(sum(n) AS BIGINT) AS consultados, count(*) FILTER (WHERE kept) AS mantidos, count(*) FILTER (WHERE NOT kept) AS descartados, CAST(sum(n-1) AS BIGINT) AS duplicados FROM k GROUP BY 1"
)
def dedup_first_wins(spark, root):
    a = table(spark, root, "atos").select("orgao", "titulo", "relevancia")
    return keyed.dedup_counts(a, "orgao", F.lower("titulo"), F.col("relevancia") == "forte")


@query("WITH s AS (SELECT p_partkey, lower(replace(p_type,' ','-')) AS base FROM part), n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS n FROM s) SELECT p_partkey, CASE WHEN n=1 THEN base ELSE base||'-'||n END AS slug FROM n")
def slug_collision(spark, root):
    p = table(spark, root, "part").select("p_partkey", F.lower(F.replace("p_type", F.lit(" "), F.lit("-"))).alias("base"))
    return keyed.suffixed(p, "base", ["p_partkey"]).select("p_partkey", "slug")


@query("WITH r AS (SELECT strftime(ts,'%Y-%m-%d') AS dia, event_id, value, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY value DESC, event_id) AS n FROM events) SELECT dia, event_id, value FROM r WHERE n=1")
def day_winner(spark, root):
    best = F.max_by(F.struct("event_id", "value"), F.struct("value", -F.col("event_id"))).alias("b")
    return table(spark, root, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("dia")).agg(best).select("dia", "b.event_id", "b.value")


@query("SELECT item, data_deteccao AS dia, count(*) AS mudancas, array_to_string(list_sort(list_distinct(list(lower(trim(campo))) FILTER (WHERE campo IS NOT NULL))),',') AS campos FROM updates GROUP BY 1,2 HAVING count(campo)>0")
def coalesce_revisions(spark, root):
    g = table(spark, root, "updates").groupBy("item", F.col("data_deteccao").alias("dia")).agg(
        F.count(F.lit(1)).alias("mudancas"), F.array_join(F.array_sort(F.collect_set(F.lower(F.trim("campo")))), ",").alias("campos"), F.count("campo").alias("c")
    )
    return g.where("c > 0").drop("c")


_TWO = "WITH o AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey%11<>0), n AS (SELECT o_orderkey, CASE WHEN o_orderkey%7=0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey%5=0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey%13<>0) "


def _two(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, root, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    new = o.where("o_orderkey % 13 <> 0").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("o_orderpriority")
    )
    return o.where("o_orderkey % 11 <> 0"), new


@query(
    _TWO
    + "SELECT o_orderkey, 'o_orderstatus' AS campo, o.o_orderstatus AS anterior, n.o_orderstatus AS novo FROM n JOIN o USING (o_orderkey) WHERE o.o_orderstatus IS DISTINCT FROM n.o_orderstatus UNION ALL SELECT o_orderkey, 'o_orderpriority', o.o_orderpriority, n.o_orderpriority FROM n JOIN o USING (o_orderkey) WHERE o.o_orderpriority IS DISTINCT FROM n.o_orderpriority"
)
def cdc_diff(spark, root):
    old, new = _two(spark, root)
    return keyed.field_changes(old, new, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query(
    _TWO
    + "SELECT coalesce(o.o_orderkey,n.o_orderkey) AS o_orderkey, coalesce(n.o_orderstatus,o.o_orderstatus) AS hash, CASE WHEN o.o_orderkey IS NULL THEN 'd2' ELSE 'd1' END AS first_seen, CASE WHEN n.o_orderkey IS NULL THEN 'd1' ELSE 'd2' END AS last_seen, CASE WHEN o.o_orderkey IS NOT NULL AND n.o_orderkey IS NOT NULL AND o.o_orderstatus<>n.o_orderstatus THEN 1 ELSE 0 END AS entradas FROM o FULL JOIN n ON o.o_orderkey=n.o_orderkey"
)
def upsert_history(spark, root):
    old, new = _two(spark, root)
    state = old.select("o_orderkey", F.col("o_orderstatus").alias("hash"), F.lit("d1").alias("first_seen"), F.lit("d1").alias("last_seen"), F.array().cast("array<struct<at:string,old:string,new:string>>").alias("history"))
    got = keyed.merged_state(state, new.select("o_orderkey", F.col("o_orderstatus").alias("h"), F.lit("d2").alias("seen")), "o_orderkey", "h", "seen")
    return got.select("o_orderkey", "hash", "first_seen", "last_seen", F.size("history").alias("entradas"))


@query("SELECT kind, id, payload FROM (SELECT kind, id, payload, row_number() OVER (PARTITION BY kind, id ORDER BY updated_at DESC, snapshot_dia DESC, payload) AS n FROM commercial_records) WHERE n=1")
def kv_upsert(spark, root):
    r = table(spark, root, "commercial_records").select("kind", "id", "payload", "updated_at", "snapshot_dia")
    return keyed.first_wins(r, ["kind", "id"], [F.desc("updated_at"), F.desc("snapshot_dia"), "payload"]).select("kind", "id", "payload")


@query("SELECT event_id, CAST(least(86400, 60*pow(2,least(event_id%15,10))) AS BIGINT) AS espera FROM events")
def retry_backoff(spark, root):
    return table(spark, root, "events").select("event_id", rules.backoff(F.col("event_id") % 15).alias("espera"))


@query("WITH e AS (SELECT event_id, CAST(floor(epoch(ts)/3600) AS BIGINT) AS janela, row_number() OVER (PARTITION BY user_id, CAST(floor(epoch(ts)/3600) AS BIGINT) ORDER BY ts, event_id) AS n FROM events) SELECT event_id, janela, n<=2 AS permitido FROM e")
def rate_limit(spark, root):
    e = table(spark, root, "events").select("event_id", "user_id", "ts")
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return keyed.within_rate(e, ["user_id"], at, 3600, 2, ["ts", "event_id"]).select("event_id", "janela", "permitido")


@query("SELECT event_id FROM events JOIN (VALUES ('view',7),('click',14),('error',3)) t(k,dias) ON event_type=k WHERE ts >= TIMESTAMP '2024-01-31' - to_days(CAST(dias AS INT))")
def ttl_purge(spark, root):
    ages = spark.createDataFrame([("view", 7), ("click", 14), ("error", 3)], "event_type string, dias int")
    e = table(spark, root, "events").select("event_id", "event_type", "ts").join(ages, "event_type")
    return e.where(F.col("ts") >= F.lit("2024-01-31").cast("timestamp_ntz") - F.make_dt_interval(F.col("dias"))).select("event_id")


@query(
    "SELECT tabela, regra, gravidade, count(*) AS n FROM (SELECT 'propositions' AS tabela, 'ausente:ementa' AS regra, 'erro' AS gravidade FROM propositions WHERE ementa IS NULL OR trim(ementa)='' UNION ALL SELECT 'propositions','ausente:comissao_atual','erro' FROM propositions WHERE comissao_atual IS NULL OR trim(comissao_atual)='' UNION ALL SELECT 'propositions','url','erro' FROM propositions WHERE NOT regexp_matches(url_oficial,'^https?://') UNION ALL SELECT 'laws','repetido','erro' FROM (SELECT id FROM laws GROUP BY id HAVING count(*)>1) UNION ALL SELECT 'updates','sem alvo:item','aviso' FROM (SELECT DISTINCT item FROM updates WHERE item IS NOT NULL AND item NOT IN (SELECT id FROM propositions) AND item NOT IN (SELECT id FROM laws) AND item NOT IN (SELECT id FROM atos WHERE id IS NOT NULL))) GROUP BY ALL"
)
def quality_report(spark, root):
    p, l, u = (table(spark, root, t) for t in ("propositions", "laws", "updates"))
    checks = quality.required(["ementa", "comissao_atual"]) | {"url": ("erro", ~F.col("url_oficial").rlike("^https?://"))}
    ids = p.select("id").union(l.select("id")).union(table(spark, root, "atos").select("id"))
    return quality.report([quality.broken(p, "propositions", "id", checks), quality.repeated(l, "laws", ["id"]), quality.dangling(u, "updates", "item", ids, "id")])


# --- reports


@query(
    f"WITH d AS (SELECT date_diff('day', DATE '{AS_OF}', try_cast(ultima_movimentacao.data AS DATE)) AS k FROM propositions) SELECT CASE WHEN k<0 THEN 'passado' WHEN k<=7 THEN 'ate 7 dias' WHEN k<=30 THEN 'ate 30 dias' ELSE 'sem janela' END AS janela, count(*) AS n FROM d GROUP BY 1"
)
def agenda_windows(spark, root):
    w = dates.window_label(dates.valid_day(F.col("ultima_movimentacao.data")), AS_OF)
    return table(spark, root, "propositions").groupBy(w.alias("janela")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH e AS (SELECT unnest(['DON','AGDI','XXX']) AS orgao), n AS (SELECT orgao, count(*) AS n, max(primeira_deteccao) AS u FROM atos GROUP BY 1) SELECT e.orgao, coalesce(n.n,0) AS n, CASE WHEN n.n IS NULL THEN 'falha' ELSE 'ok' END AS status FROM e LEFT JOIN n USING (orgao)"
)
def expected_sources(spark, root):
    expected = spark.createDataFrame([("DON",), ("AGDI",), ("XXX",)], "orgao string")
    n = table(spark, root, "atos").groupBy("orgao").agg(F.count(F.lit(1)).alias("n"))
    return expected.join(n, "orgao", "left").select("orgao", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n").isNull(), "falha").otherwise("ok").alias("status"))


@query("WITH q AS (SELECT o_orderkey, o_totalprice, o_orderdate, count(*) OVER () - 25 AS adiados FROM orders WHERE o_orderstatus='O') SELECT o_orderkey, adiados FROM q ORDER BY o_totalprice DESC, o_orderdate, o_orderkey LIMIT 25")
def queue_admission(spark, root):
    q = table(spark, root, "orders").where("o_orderstatus = 'O'")
    first = q.select("o_orderkey", "o_totalprice", "o_orderdate").orderBy(F.desc("o_totalprice"), "o_orderdate", "o_orderkey").limit(25).select("o_orderkey", F.lit(1).alias("k"))
    n = q.agg((F.count(F.lit(1)) - 25).alias("adiados")).withColumn("k", F.lit(1))  # one row
    return first.join(n, "k").select("o_orderkey", "adiados")


@query("SELECT split_part(id,'_',1) AS casa, count(*) AS fichas, count(*) FILTER (WHERE ementa IS NULL) AS sem_ementa, count(*) FILTER (WHERE removida_em IS NOT NULL) AS removidas FROM propositions GROUP BY 1")
def house_health(spark, root):
    return table(spark, root, "propositions").groupBy(F.substring_index("id", "_", 1).alias("casa")).agg(
        F.count(F.lit(1)).alias("fichas"), F.count_if(F.col("ementa").isNull()).alias("sem_ementa"), F.count_if(F.col("removida_em").isNotNull()).alias("removidas")
    )


@query("WITH r AS (SELECT orgao, registro, row_number() OVER (PARTITION BY orgao ORDER BY data DESC NULLS LAST, registro) AS n FROM atos) SELECT orgao, registro FROM r WHERE n<=5")
def sample_items(spark, root):
    w = Window.partitionBy("orgao").orderBy(F.col("data").desc_nulls_last(), "registro")
    return table(spark, root, "atos").select("orgao", "registro", "data").withColumn("n", F.row_number().over(w)).where("n <= 5").select("orgao", "registro")


@query(
    "WITH f AS (SELECT unnest(list_filter([CASE WHEN value<5 THEN 'valor baixo' END, CASE WHEN event_type='error' THEN 'erro' END, CASE WHEN event_type='purchase' AND value>50 THEN 'compra alta' END], x -> x IS NOT NULL)) AS alerta FROM events) SELECT alerta, count(*) AS n FROM f GROUP BY 1".replace("x -> x IS NOT NULL", "lambda x: x IS NOT NULL")
)
def alert_rules(spark, root):
    t, v = F.col("event_type"), F.col("value")
    f = rules.flags({"valor baixo": v < 5, "erro": t == "error", "compra alta": (t == "purchase") & (v > 50)})
    return table(spark, root, "events").select(F.explode(f).alias("alerta")).groupBy("alerta").agg(F.count(F.lit(1)).alias("n"))


@query("WITH m AS (SELECT DISTINCT unnest(regexp_extract_all(coalesce(descricao,'') || ' ' || coalesce(titulo,''),'processo (\\d+/\\d{4})',1)) AS processo FROM atos) SELECT processo FROM m")
def extracted_ids(spark, root):
    both = F.concat_ws(" ", F.coalesce("descricao", F.lit("")), F.coalesce("titulo", F.lit("")))
    return table(spark, root, "atos").select(F.explode(F.regexp_extract_all(both, F.lit(r"processo (\d+/\d{4})"), F.lit(1))).alias("processo")).distinct()


@query(
    "WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(coalesce(ementa_sintese,'') || ' ' || coalesce(relacao_ia,''),'[A-Z]{2,4} \\d+/\\d{4}')) AS m FROM laws) SELECT id FROM propositions WHERE titulo NOT IN (SELECT m FROM t WHERE m IS NOT NULL)"
)
def not_mentioned(spark, root):
    both = F.concat_ws(" ", F.coalesce("ementa_sintese", F.lit("")), F.coalesce("relacao_ia", F.lit("")))
    named = table(spark, root, "laws").select(F.explode(F.regexp_extract_all(both, F.lit(r"[A-Z]{2,4} \d+/\d{4}"), F.lit(0))).alias("titulo")).distinct()
    return table(spark, root, "propositions").join(named, "titulo", "left_anti").select("id")
