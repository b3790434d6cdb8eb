"""Further queries: states, checks of forms, deliveries, health of runs, ordered lists and reports, each with the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, forms, rules, states, text
from ..operators import delivery, health
from ..sources.tables import table
from .catalogue import AS_OF, fold_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _any(c: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c},'{w}')" for w in words) + ")"


# --- states and labels

_TOLD = "trim(trim(passo) || ' (' || trim(casa) || '): ' || substr(trim(ordem),1,220))"


@query(
    f"WITH p AS (SELECT id, coalesce(situacao,'') AS antes, coalesce(ultima_movimentacao.descricao,'') AS passo, coalesce(ementa,'') AS ordem, coalesce(comissao_atual,'') AS casa, {fold_sql('situacao')} AS s, {fold_sql("coalesce(ultima_movimentacao.descricao,'') || ' ' || coalesce(ementa,'')")} AS t FROM propositions) "
    f"SELECT id, CASE WHEN contains(t,'desarquiv') THEN 'Desarquivada — ' || {_TOLD} WHEN {_any('s', states.ENDED)} THEN antes WHEN contains(t,'apens') AND NOT contains(t,'desapens') THEN antes WHEN contains(t,'desapens') THEN 'Desapensada — ' || {_TOLD} WHEN contains(s,'sancao') AND contains(t,'sancao') THEN antes "
    f"WHEN {_any('t', states.BECAME_LAW)} THEN trim('Convertida em norma — ' || trim(passo) || ': ' || substr(trim(ordem),1,220)) WHEN contains(t,'sancao') THEN 'Aguarda sanção presidencial' WHEN {_any('t', states.DECISIVE)} THEN {_TOLD} ELSE antes END AS situacao FROM p"
)
def situations(spark, root):
    p = table(spark, root, "propositions")
    return p.select("id", states.situation(F.col("situacao"), F.col("ultima_movimentacao.descricao"), F.col("ementa"), F.col("comissao_atual"), F.col("ultima_movimentacao.data")).alias("situacao"))


@query(f"SELECT id, {_any(fold_sql('situacao'), states.NEAR_VOTE)} AS perto, coalesce(nullif(proposicao_principal,''), CASE WHEN regexp_matches(situacao,'Apensad[oa] ao ([A-Z]{{2,4}})\\s*(\\d{{1,5}})/(\\d{{4}})') THEN lower(regexp_replace(regexp_extract(situacao,'([A-Z]{{2,4}}\\s*\\d{{1,5}}/\\d{{4}})',1),'^([A-Z]+)\\s*(\\d+)/(\\d+)$','camara_\\1_\\2_\\3')) END) AS principal FROM propositions")
def near_votes(spark, root):
    return table(spark, root, "propositions").select("id", states.near_vote(F.col("situacao")).alias("perto"), states.guessed_principal(F.col("proposicao_principal"), F.col("situacao")).alias("principal"))


@query(
    "WITH r AS (SELECT id_execucao_primeira AS run, orgao, count(*) AS vistos, count(*) FILTER (WHERE data IS NULL) AS falhas, count(*) FILTER (WHERE fonte IS NULL) AS sem_fonte FROM atos GROUP BY ALL) SELECT run, orgao, CASE WHEN vistos<=0 THEN 'falha' WHEN falhas>0 THEN 'parcial' ELSE 'ok' END AS casa, CASE WHEN vistos-sem_fonte=0 THEN 'falha' WHEN falhas>1 THEN 'parcial' ELSE 'ok' END AS fonte FROM r"
)
def source_states(spark, root):
    r = table(spark, root, "atos").groupBy(F.col("id_execucao_primeira").alias("run"), "orgao").agg(F.count(F.lit(1)).alias("vistos"), F.count_if(F.col("data").isNull()).alias("falhas"), F.count_if(F.col("fonte").isNull()).alias("sem_fonte"))
    return r.select("run", "orgao", states.house_status(F.col("vistos"), F.col("falhas")).alias("casa"), states.source_status(F.col("vistos") - F.col("sem_fonte"), F.when(F.col("falhas") > 1, F.col("falhas")), F.lit(None).cast("boolean")).alias("fonte"))


@query(
    "WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'em_andamento' WHEN 'click' THEN 'parcial' WHEN 'error' THEN 'falhou' ELSE 'falha' END AS st, round((epoch(TIMESTAMP '2024-01-31')-epoch(date_trunc('minute',ts)))/3600.0,6) AS h FROM events) "
    "SELECT event_id, CASE WHEN st='em_andamento' THEN CASE WHEN h>3 THEN 'interrompida' ELSE 'em_andamento' END WHEN st IN ('parcial','falhou') THEN st ELSE 'concluida' END AS mostrado, h<48 AS em_horas FROM e"
)
def run_states(spark, root):
    st = F.when(F.col("event_type") == "view", "em_andamento").when(F.col("event_type") == "click", "parcial").when(F.col("event_type") == "error", "falhou").otherwise("falha")
    at = F.unix_timestamp(F.date_trunc("minute", "ts").cast("timestamp"))
    h = F.round((F.unix_timestamp(F.lit("2024-01-31 00:00:00").cast("timestamp")) - at) / 3600.0, 6)
    return table(spark, root, "events").select("event_id", states.run_status(st, h).alias("mostrado"), states.age_text(h).endswith(" h").alias("em_horas"))


_DAY = "nullif(regexp_extract(CAST({0} AS VARCHAR),'^\\s*(\\d{{4}}-\\d{{2}}-\\d{{2}})',1),'')"


@query(f"SELECT update_id, coalesce(CASE WHEN {_DAY.format('data_deteccao')}>='2020-01-01' THEN {_DAY.format('data_deteccao')} END, CASE WHEN {_DAY.format('timestamp_execucao')}>='2020-01-01' THEN {_DAY.format('timestamp_execucao')} END, CASE WHEN {_DAY.format('data')}>='2020-01-01' THEN {_DAY.format('data')} END, '{AS_OF}') AS dia, strftime(timestamp_execucao,'%Y-%m-%d') AS execucao FROM updates")
def editorial_days(spark, root):
    run = F.date_format("timestamp_execucao", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, root, "updates").select("update_id", states.first_day([F.col("data_deteccao"), F.col("timestamp_execucao"), F.col("data")], "2020-01-01", F.lit(AS_OF)).alias("dia"), states.run_day(run).alias("execucao"))


@query(f"WITH u AS (SELECT item, max(CASE WHEN regexp_matches(data,'^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN left(data,10) END) AS u FROM updates GROUP BY 1) SELECT id, coalesce(greatest(data_apresentacao, ultima_movimentacao.data, u), '{AS_OF}') AS mudado FROM propositions LEFT JOIN u ON id=item")
def last_changed(spark, root):
    day = F.when(F.col("data").rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring("data", 1, 10))
    u = table(spark, root, "updates").groupBy("item").agg(F.max(day).alias("u"))
    p = table(spark, root, "propositions").select("id", "data_apresentacao", F.col("ultima_movimentacao.data").alias("m")).join(u, F.col("id") == F.col("item"), "left")
    return p.select("id", F.coalesce(F.greatest("data_apresentacao", "m", "u"), F.lit(AS_OF)).alias("mudado"))


@query(
    f"WITH t AS (SELECT update_id, trim(regexp_replace(regexp_replace(coalesce(titulo,''),'\\(\\s*registro incorporado\\s*\\)|\\(\\s*alinhamento de texto à ficha oficial\\s*\\)',' ','gi'),'\\s+',' ','g')) AS titulo, {fold_sql('trim(titulo)')} AS f FROM updates) SELECT update_id, titulo, regexp_matches({fold_sql('titulo')},'{states.PROTOCOL}') AS eco, regexp_matches(f,'^({'|'.join(states.NOISE)})') AS ruido FROM t"
)
def clean_titles(spark, root):
    t = F.col("titulo")
    return table(spark, root, "updates").select("update_id", states.clean_title(t).alias("titulo"), states.protocol_echo(t).alias("eco"), states.noisy(t).alias("ruido"))


_SLUG = "regexp_replace(left(regexp_replace(regexp_replace(replace(replace(lower(strip_accents({0})),'º','o'),'ª','a'),'[^a-z0-9]+','-','g'),'^-+|-+$','','g'),60),'-+$','')"


@query(
    f"WITH p AS (SELECT id, coalesce(proposicao_principal,id) AS alvo, lower(tipo)||'-'||numero||'-'||ano||'-'||{_SLUG.format('titulo')} AS topico FROM propositions), a AS (SELECT id, any_value(DISTINCT 'ato-'||orgao||'-'||left(sha1(id),8)) AS topico FROM atos GROUP BY id) "
    "SELECT u.update_id, CASE WHEN p.id IS NOT NULL THEN 'prop' WHEN a.id IS NOT NULL THEN 'ato' END AS entidade, coalesce(p.topico, a.topico) AS topico FROM updates u LEFT JOIN p ON u.item=p.id LEFT JOIN a ON u.item=a.id"
)
def topics(spark, root):
    p = table(spark, root, "propositions").select(F.col("id").alias("pid"), F.concat_ws("-", F.lower("tipo"), F.col("numero"), F.col("ano"), text.slug(F.col("titulo"), 60)).alias("pt"))
    a = table(spark, root, "atos").groupBy(F.col("id").alias("aid")).agg(F.first("orgao").alias("o")).select("aid", F.concat_ws("-", F.lit("ato"), "o", F.substring(F.sha1("aid"), 1, 8)).alias("at"))
    u = table(spark, root, "updates").select("update_id", "item")
    j = u.join(p, F.col("item") == F.col("pid"), "left").join(a, F.col("item") == F.col("aid"), "left")
    return j.select("update_id", F.when(F.col("pid").isNotNull(), "prop").when(F.col("aid").isNotNull(), "ato").alias("entidade"), F.coalesce("pt", "at").alias("topico"))


@query("SELECT id, tipo || ' ' || numero || '/' || ano AS rotulo, replace(regexp_replace(id,'^(camara|senado)_',''),'_','-') AS caminho, 'Monitor: ' || tipo || ' ' || numero || ' de ' || ano || ' (' || coalesce(casa_atual,'—') || ')' AS descricao FROM propositions")
def page_labels(spark, root):
    return table(spark, root, "propositions").select(
        "id", F.format_string("%s %d/%d", "tipo", "numero", "ano").alias("rotulo"), F.replace(F.regexp_replace("id", "^(camara|senado)_", ""), F.lit("_"), F.lit("-")).alias("caminho"),
        F.format_string("Monitor: %s %d de %d (%s)", F.col("tipo"), F.col("numero"), F.col("ano"), F.coalesce("casa_atual", F.lit("—"))).alias("descricao"),
    )


# --- filters and orders


@query("SELECT id, orgao, contains(lower(coalesce(url_oficial,'')),'don.example') OR contains(lower(coalesce(url_oficial,'')),'agdi.example') AS oficial FROM (SELECT DISTINCT id, orgao, url_oficial FROM atos WHERE tipo IN ('ato','noticia') AND NOT (relevancia='infra' AND tipo='ato') AND (hierarquia IS NULL OR starts_with(lower(strip_accents(hierarquia)),'diario') OR contains(lower(strip_accents(hierarquia)),'secretaria')) AND NOT regexp_matches(lower(url_oficial),'\\.(png|jpe?g|gif|svg)$'))")
def act_filters(spark, root):
    h, u = F.when(F.col("hierarquia").isNotNull(), text.fold(F.col("hierarquia"))), F.lower(F.coalesce("url_oficial", F.lit("")))
    a = table(spark, root, "atos").where(F.col("tipo").isin("ato", "noticia") & ~((F.col("relevancia") == "infra") & (F.col("tipo") == "ato")))
    a = a.where((h.isNull() | h.startswith("diario") | h.contains("secretaria")) & ~u.rlike(r"\.(png|jpe?g|gif|svg)$"))
    return a.select("id", "orgao", "url_oficial").distinct().select("id", "orgao", (F.lower(F.coalesce("url_oficial", F.lit(""))).contains("don.example") | F.lower(F.coalesce("url_oficial", F.lit(""))).contains("agdi.example")).alias("oficial"))


@query(f"WITH d AS (SELECT update_id, coalesce(date_diff('day', try_cast(data AS DATE), DATE '{AS_OF}'), 9999) AS dias FROM updates) SELECT n AS periodo, count(*) AS mudancas FROM d, (VALUES (0),(7),(30),(3650)) t(n) WHERE dias<=n GROUP BY 1")
def period_filter(spark, root):
    day = F.coalesce(dates.days_since(dates.valid_day(F.col("data")), AS_OF), F.lit(9999))
    within = F.filter(F.array(*[F.lit(n) for n in (0, 7, 30, 3650)]), lambda n: day <= n)
    return table(spark, root, "updates").select(F.explode(within).alias("periodo")).groupBy("periodo").agg(F.count(F.lit(1)).alias("mudancas"))


@query("SELECT CASE WHEN o_totalprice>=240000 THEN '80+' WHEN o_totalprice>=180000 THEN '60-79' ELSE '<60' END AS faixa, count(*) AS n FROM orders GROUP BY 1")
def impact_filter(spark, root):
    f = rules.band(F.floor(F.col("o_totalprice") / 3000), [(60, "60-79"), (80, "80+")], "<60")
    return table(spark, root, "orders").groupBy(f.alias("faixa")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT id, data FROM (SELECT DISTINCT id, data, status FROM laws) WHERE contains(lower(coalesce(status,'')),'vigor') ORDER BY data DESC NULLS LAST, id LIMIT 3")
def newest_laws(spark, root):
    return table(spark, root, "laws").select("id", "data", "status").distinct().where(F.lower("status").contains("vigor")).select("id", "data").orderBy(F.desc_nulls_last("data"), "id").limit(3)


@query("SELECT update_id, row_number() OVER (ORDER BY coalesce(data,'') DESC, coalesce(titulo,'') DESC, update_id) AS lugar FROM updates ORDER BY lugar LIMIT 50")
def newest_changes(spark, root):
    top = table(spark, root, "updates").select("update_id", F.coalesce("data", F.lit("")).alias("d"), F.coalesce("titulo", F.lit("")).alias("t")).orderBy(F.desc("d"), F.desc("t"), "update_id").limit(50)
    return top.select("update_id", F.row_number().over(Window.orderBy(F.desc("d"), F.desc("t"), "update_id")).alias("lugar"))


@query("WITH r AS (SELECT id_execucao AS run, max(timestamp_execucao) AS fim FROM updates GROUP BY 1) SELECT run, strftime(fim,'%Y-%m-%d %H:%M:%S') AS fim FROM r ORDER BY fim DESC, run LIMIT 15")
def newest_runs(spark, root):
    r = table(spark, root, "updates").groupBy(F.col("id_execucao").alias("run")).agg(F.max("timestamp_execucao").alias("fim"))
    return r.orderBy(F.desc("fim"), "run").limit(15).select("run", F.date_format("fim", "yyyy-MM-dd HH:mm:ss").alias("fim"))


@query("SELECT kind, id, criado FROM (SELECT DISTINCT kind, id, created_at AS criado FROM commercial_records WHERE kind='outbox') ORDER BY criado, id LIMIT 100")
def stored_list(spark, root):
    r = table(spark, root, "commercial_records").where("kind = 'outbox'").select("kind", "id", F.col("created_at").alias("criado")).distinct()
    return r.orderBy("criado", "id").limit(100)


@query("SELECT registro, coalesce(nullif(strftime(ultima_verificacao,'%Y-%m-%d'),''), data) AS mudado FROM atos ORDER BY coalesce(ultima_verificacao, primeira_deteccao) DESC, primeira_deteccao DESC, registro LIMIT 12")
def newest_acts(spark, root):
    a = table(spark, root, "atos").select("registro", "data", "ultima_verificacao", "primeira_deteccao")
    a = a.orderBy(F.desc(F.coalesce("ultima_verificacao", "primeira_deteccao")), F.desc("primeira_deteccao"), "registro").limit(12)
    return a.select("registro", F.coalesce(F.date_format("ultima_verificacao", "yyyy-MM-dd"), "data").alias("mudado"))


@query("SELECT update_id FROM updates WHERE tipo='novo andamento' AND data_deteccao BETWEEN '2026-07-01' AND '2026-07-31' ORDER BY data_deteccao DESC, update_id LIMIT 4")
def newest_of_kind(spark, root):
    u = table(spark, root, "updates").where("tipo = 'novo andamento' AND data_deteccao BETWEEN '2026-07-01' AND '2026-07-31'")
    return u.orderBy(F.desc("data_deteccao"), "update_id").limit(4).select("update_id")


# --- joins


@query(
    "WITH r AS (SELECT DISTINCT id, lower(trim(x)) AS p FROM (SELECT id, unnest(proposicoes_relacionadas) AS x FROM parliamentarians)) SELECT DISTINCT p.id AS proposicao, r.id AS parlamentar FROM propositions p JOIN r ON r.p=p.id UNION SELECT DISTINCT p.id, m.id FROM propositions p JOIN parliamentarians m ON m.nome=p.relator.nome"
)
def by_id_or_name(spark, root):
    m = table(spark, root, "parliamentarians")
    p = table(spark, root, "propositions").select(F.col("id").alias("proposicao"), F.col("relator.nome").alias("relator"))
    named = m.select(F.col("id").alias("parlamentar"), F.explode("proposicoes_relacionadas").alias("x")).select("parlamentar", F.lower(F.trim("x")).alias("proposicao")).distinct()
    one = named.join(p.select("proposicao"), "proposicao", "left_semi").select("proposicao", "parlamentar")
    two = p.join(m.select(F.col("id").alias("parlamentar"), "nome"), F.col("relator") == F.col("nome")).select("proposicao", "parlamentar")
    return one.unionByName(two).distinct()


@query("WITH l AS (SELECT DISTINCT registro, x FROM (SELECT registro, unnest(list_concat(coalesce(canais,[]), list_transform(coalesce(historico,[]), lambda h: h.campo))) AS x FROM atos)) SELECT x AS nome, count(*) AS n FROM l WHERE x IS NOT NULL GROUP BY 1")
def joined_lists(spark, root):
    h = F.coalesce(F.transform("historico", lambda x: x["campo"]), F.array().cast("array<string>"))
    x = table(spark, root, "atos").select("registro", F.explode(F.array_union(F.coalesce("canais", F.array().cast("array<string>")), h)).alias("nome"))
    return x.where("nome IS NOT NULL").groupBy("nome").agg(F.count(F.lit(1)).alias("n"))


@query("WITH f AS (SELECT l.id, min(c.id) AS c FROM (SELECT id, unnest(categorias) AS k FROM laws) l JOIN categories c ON c.id=l.k GROUP BY 1) SELECT DISTINCT laws.id, categories.nome AS primeira FROM laws LEFT JOIN f ON f.id=laws.id LEFT JOIN categories ON categories.id=f.c")
def first_match(spark, root):
    laws = table(spark, root, "laws")
    c = table(spark, root, "categories").select(F.col("id").alias("k"), "nome")
    f = laws.select("id", F.explode("categorias").alias("k")).join(c, "k").groupBy("id").agg(F.min_by("nome", "k").alias("primeira"))
    return laws.select("id").distinct().join(f, "id", "left")


_LATEST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind, id ORDER BY updated_at DESC, snapshot_dia DESC, payload) AS n FROM commercial_records WHERE kind='{0}') WHERE n=1)"


def _latest(spark: SparkSession, root: str, kind: str) -> DataFrame:
    r = table(spark, root, "commercial_records").where(F.col("kind") == kind)
    row = F.struct("id", "account_id", "payload", "created_at", "updated_at")
    return r.groupBy("id").agg(F.max_by(row, F.struct("updated_at", "snapshot_dia")).alias("r")).select("r.*")


_NOW = 1783000000


@query(f"WITH s AS (SELECT id, payload->>'frequencia' AS f, CAST(payload->>'confirmed_at' AS BIGINT) AS c, payload->>'active' AS a, account_id FROM commercial_records WHERE kind='subscription' AND snapshot_dia=(SELECT max(snapshot_dia) FROM commercial_records)) SELECT DISTINCT s.id FROM s WHERE a='true' AND {_NOW}-coalesce(c,{_NOW})>=CASE f WHEN 'imediato' THEN 0 WHEN 'imediata' THEN 0 WHEN 'diario' THEN 86400 WHEN 'diaria' THEN 86400 WHEN 'semanal' THEN 604800 END AND (account_id IS NULL OR account_id='' OR EXISTS (SELECT 1 FROM commercial_records k WHERE k.kind='account' AND k.id=s.account_id))")
def due_subscriptions(spark, root):
    c = table(spark, root, "commercial_records").select("kind", "id", "account_id", "payload", "snapshot_dia")
    last = c.agg(F.max("snapshot_dia").alias("last"))
    s = c.where("kind = 'subscription'").join(last, F.col("snapshot_dia") == F.col("last"), "left_semi")
    get = lambda p: F.get_json_object("payload", f"$.{p}")
    s = s.where(get("active") == "true").select("id", "account_id", F.regexp_replace(get("frequencia"), "a$", "o").alias("frequencia"), get("confirmed_at").cast("bigint").alias("last"))
    s = s.withColumn("frequencia", F.when(F.col("frequencia") == "semanol", "semanal").otherwise(F.col("frequencia")))
    accounts = c.where("kind = 'account'").select(F.col("id").alias("account_id"), F.lit("active").alias("status"), F.lit(None).cast("string").alias("ends_on")).distinct()
    return delivery.served(delivery.due(s, F.lit(_NOW)), accounts, "account_id", F.lit(AS_OF)).select("id").distinct()


@query(
    "WITH o AS (SELECT DISTINCT id, payload->>'status' AS st, CAST(payload->>'attempts' AS INT) AS n, CAST(payload->>'next_attempt' AS BIGINT) AS due FROM commercial_records WHERE kind='outbox'), "
    f"t AS (SELECT *, st IN ('sent','cancelled') OR coalesce(due,0)>{_NOW} AS k, right(id,1) IN ('0','1') AS unwanted, right(id,1) IN ('2','3','4') AS fails, coalesce(n,0)+1 AS m FROM o) "
    f"SELECT id, st AS antes, n AS antes_n, due AS antes_due, CASE WHEN k THEN st WHEN unwanted THEN 'cancelled' WHEN fails THEN 'retry' ELSE 'sent' END AS status, CASE WHEN k OR unwanted THEN n ELSE m END AS attempts, CASE WHEN k OR unwanted THEN due WHEN fails THEN {_NOW}+CAST(least(86400,60*pow(2,least(m,10))) AS BIGINT) ELSE {_NOW}+300 END AS due FROM t"
)
def outbox_step(spark, root):
    get = lambda p: F.get_json_object("payload", f"$.{p}")
    o = table(spark, root, "commercial_records").where("kind = 'outbox'").select("id", get("status").alias("antes"), get("attempts").cast("int").alias("antes_n"), get("next_attempt").cast("bigint").alias("antes_due")).distinct()
    end = F.right("id", F.lit(1))
    step = states.outbox_next(F.col("antes"), F.col("antes_n"), F.col("antes_due"), F.lit(_NOW).cast("bigint"), ~end.isin("0", "1"), F.when(end.isin("2", "3", "4"), "falha").otherwise("ok"))
    return o.select("id", "antes", "antes_n", "antes_due", step.alias("s")).select("id", "antes", "antes_n", "antes_due", "s.status", "s.attempts", "s.due")


@query("SELECT c.c_custkey, o.o_orderkey FROM customer c JOIN orders o ON o.o_custkey=c.c_custkey WHERE o.o_totalprice>=200000 AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey=o.o_orderkey AND l.l_returnflag='R')")
def undelivered(spark, root):
    o = table(spark, root, "orders").where("o_totalprice >= 200000").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    matched = o.join(table(spark, root, "customer").select("c_custkey"), "c_custkey").select("c_custkey", "o_orderkey")
    return delivery.undelivered(matched, table(spark, root, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


_PRICES = "WITH b AS (SELECT p_partkey, p_type AS v FROM part WHERE p_partkey%11<>0), n AS (SELECT p_partkey, CASE WHEN p_partkey%7=0 THEN 'X' ELSE p_type END AS v FROM part) "


@query(_PRICES + "SELECT n.p_partkey, b.v AS before, n.v AS after, sha256(n.p_partkey||'|'||coalesce(b.v,'')||'|'||coalesce(n.v,'')) AS change_id FROM n LEFT JOIN b USING (p_partkey) WHERE b.p_partkey IS NULL OR b.v IS DISTINCT FROM n.v")
def content_changes(spark, root):
    p = table(spark, root, "part").select("p_partkey", F.col("p_type").alias("v"))
    new = p.select("p_partkey", F.when(F.col("p_partkey") % 7 == 0, "X").otherwise(F.col("v")).alias("v"))
    return delivery.content_changes(p.where("p_partkey % 11 <> 0"), new, ["p_partkey"], "v")


@query(_PRICES + "SELECT DISTINCT n.p_partkey, CASE WHEN b.p_partkey IS NULL THEN 'novo' WHEN b.v=n.v THEN 'repetido' ELSE 'conflito' END AS resultado FROM n LEFT JOIN b USING (p_partkey)")
def requests(spark, root):
    p = table(spark, root, "part").select("p_partkey", F.col("p_type").alias("v"))
    new = p.select("p_partkey", F.when(F.col("p_partkey") % 7 == 0, "X").otherwise(F.col("v")).alias("v"))
    return delivery.requested(p.where("p_partkey % 11 <> 0"), new.unionByName(new.where("p_partkey % 3 = 0")), "p_partkey", ["v"])


@query("WITH r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) SELECT o_orderkey, n=1 AS active FROM r")
def one_active(spark, root):
    return delivery.latest_active(table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"), ["o_custkey", "o_orderpriority"], "o_orderkey", "o_orderdate")


@query("SELECT update_id, coalesce(data <= strftime(timestamp_execucao - INTERVAL 30 DAY,'%Y-%m-%d'), false) AS tardio, strftime(timestamp_execucao - INTERVAL 1 DAY,'%Y-%m-%d') AS desde FROM updates WHERE data LIKE '____-__-__'")
def late_facts(spark, root):
    u = table(spark, root, "updates").where("data LIKE '____-__-__'").select("update_id", "data", "timestamp_execucao")
    back = lambda n: F.date_format(F.date_sub(F.col("timestamp_execucao").cast("date"), n), "yyyy-MM-dd")
    return delivery.late_facts(u, F.col("data"), back(30)).select("update_id", "tardio", back(1).alias("desde"))


@query("WITH p AS (SELECT user_id, CAST(floor(event_id/50) AS BIGINT) AS page, count(*) AS n FROM events GROUP BY ALL), f AS (SELECT user_id, min(page) AS f FROM p WHERE n<2 GROUP BY 1) SELECT p.user_id, page, n FROM p LEFT JOIN f USING (user_id) WHERE page<=coalesce(f,page)")
def pages_in_use(spark, root):
    p = table(spark, root, "events").groupBy("user_id", F.floor(F.col("event_id") / 50).cast("bigint").alias("page")).agg(F.count(F.lit(1)).alias("n"))
    return delivery.pages_in_use(p, "user_id", "page", "n", 2)


# --- checks


@query(
    "WITH r AS (SELECT id, CASE WHEN email IS NULL OR NOT regexp_matches(lower(trim(email)),'^[^\\s<>@,;]+@[^\\s<>@,;]+\\.[^\\s<>@,;]+$') THEN 'email' WHEN nome IS NULL OR length(nome)>256 THEN 'nome' WHEN estagio IS NULL OR estagio NOT IN ('novo','contato','lead','demo') THEN 'estagio' WHEN NOT regexp_matches(id,'^[a-zA-Z0-9-]{16,64}$') THEN 'id' END AS erro FROM (SELECT DISTINCT id, payload->>'email' AS email, payload->>'name' AS nome, payload->>'stage' AS estagio FROM commercial_records WHERE kind='lead')) SELECT coalesce(erro,'valido') AS erro, count(*) AS n FROM r GROUP BY 1"
)
def form_checks(spark, root):
    get = lambda p: F.get_json_object("payload", f"$.{p}")
    r = table(spark, root, "commercial_records").where("kind = 'lead'").select("id", get("email").alias("email"), get("name").alias("nome"), get("stage").alias("estagio")).distinct()
    got = forms.checked(r, {"email": forms.is_email(F.col("email")), "nome": forms.plain(F.col("nome")), "estagio": F.col("estagio").isin("novo", "contato", "lead", "demo"), "id": forms.is_request_id(F.col("id"))})
    return got.groupBy(F.coalesce("erro", F.lit("valido")).alias("erro")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, concat_ws('|', CASE WHEN length(c_name)<=160 THEN 'page='||c_name END, CASE WHEN c_custkey%3<>0 THEN 'source='||c_mktsegment END) AS origem, CASE WHEN c_custkey%2=0 THEN lpad(CAST(c_custkey AS VARCHAR),14,'0') END AS cnpj FROM customer")
def origins(spark, root):
    c = table(spark, root, "customer")
    m = F.create_map(F.lit("page"), F.col("c_name"), F.lit("source"), F.when(F.col("c_custkey") % 3 == 0, F.concat("c_mktsegment", F.lit("@"))).otherwise(F.col("c_mktsegment")), F.lit("other"), F.lit("x"))
    held = F.map_concat(forms.origin(m), F.create_map(F.lit("timestamp"), F.lit("0")))
    shown = F.concat_ws("|", F.concat(F.lit("page="), held["page"]), F.concat(F.lit("source="), held["source"]))
    digits = F.lpad(F.col("c_custkey").cast("string"), 14, "0")
    typed = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.substring(digits, 1, 2), F.lit("."), F.substring(digits, 3, 6), F.lit("/"), F.substring(digits, 9, 6))).otherwise(F.concat(F.lit("x"), digits))
    return c.select("c_custkey", shown.alias("origem"), forms.company_number(typed).alias("cnpj"))


@query(
    "WITH r AS (SELECT id_execucao_primeira AS run, orgao, count(*) AS n, count(*) FILTER (WHERE data IS NULL) AS e FROM atos GROUP BY ALL), s AS (SELECT run, sum(n) AS n, sum(e) AS e, count(*) FILTER (WHERE e>2) AS f FROM r GROUP BY 1), c AS (SELECT *, 100.0*(n-e)/n AS cob FROM s) "
    "SELECT run, 'cobertura' AS regra, 'problema' AS gravidade FROM c WHERE cob<100 UNION ALL SELECT run, 'erros', 'problema' FROM c WHERE e>0 UNION ALL SELECT run, 'fontes_falha', 'problema' FROM c WHERE f>0 UNION ALL SELECT run, 'fonte:'||orgao, 'problema' FROM r WHERE e>2 UNION ALL SELECT run, 'fonte:'||orgao, 'aviso' FROM r WHERE e BETWEEN 1 AND 2"
)
def run_health(spark, root):
    r = table(spark, root, "atos").groupBy(F.col("id_execucao_primeira").alias("run"), "orgao").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("data").isNull()).alias("erros"))
    r = r.withColumn("status", F.when(F.col("erros") > 2, "falha").otherwise("ok"))
    runs = r.groupBy("run").agg((100.0 * (F.sum("n") - F.sum("erros")) / F.sum("n")).alias("cobertura_pct"), F.sum("erros").alias("erros"), F.count_if(F.col("status") == "falha").alias("fontes_falha")).withColumn("status", F.lit("concluida"))
    return health.problems(runs, "run").unionByName(health.source_problems(r, "run", "orgao"))


@query("SELECT w.id, CASE WHEN p.id IS NULL THEN 'ausente' ELSE 'divergente' END AS problema FROM (VALUES ('camara_pl_77_2024','https://www.camara.example/materia/pl-77-2024'),('camara_pl_0_1900','https://x'),('senado_pec_104_2024','https://y')) w(id,url) LEFT JOIN propositions p ON p.id=w.id WHERE p.id IS NULL OR p.url_oficial IS DISTINCT FROM w.url")
def watchlist(spark, root):
    w = spark.createDataFrame([("camara_pl_77_2024", "https://www.camara.example/materia/pl-77-2024"), ("camara_pl_0_1900", "https://x"), ("senado_pec_104_2024", "https://y")], "id string, url string")
    return health.watched(w, table(spark, root, "propositions").select("id", F.col("url_oficial").alias("url")), "id", "url")


@query(
    "SELECT 'score' AS regra, CAST(count(*) AS BIGINT) AS n FROM orders WHERE NOT floor(o_totalprice/3000) BETWEEN 0 AND 100 UNION ALL SELECT 'revisao', count(*) FROM atos WHERE ultima_verificacao < primeira_deteccao UNION ALL SELECT 'primeira_revisao', count(*) FROM atos WHERE len(historico)>0 AND historico[1].data_deteccao IS DISTINCT FROM strftime(primeira_deteccao,'%Y-%m-%d') "
    "UNION ALL SELECT 'cota', count(*) FROM (SELECT data_deteccao FROM updates GROUP BY 1 HAVING count(*)>20) UNION ALL SELECT 'slug', count(*) FROM categories WHERE NOT regexp_matches(slug,'^[a-z0-9]+(?:-[a-z0-9]+)*$') UNION ALL SELECT 'pendente', count(*) FROM (SELECT item FROM updates WHERE campo IS NULL INTERSECT SELECT item FROM updates WHERE campo IS NOT NULL)"
)
def article_checks(spark, root):
    a, u = table(spark, root, "atos"), table(spark, root, "updates")
    n = lambda rule, rows: rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("regra"), "n")
    first = F.try_element_at("historico", F.lit(1))["data_deteccao"]
    parts = [
        n("score", table(spark, root, "orders").where(~F.floor(F.col("o_totalprice") / 3000).between(0, 100))),
        n("revisao", a.where("ultima_verificacao < primeira_deteccao")),
        n("primeira_revisao", a.where((F.size("historico") > 0) & ~first.eqNullSafe(F.date_format("primeira_deteccao", "yyyy-MM-dd")))),
        n("cota", health.over_quota(u, "data_deteccao", 20)), n("slug", table(spark, root, "categories").where(~F.col("slug").rlike(forms.SLUG))),
        n("pendente", u.where("campo IS NULL").select("item").intersect(u.where("campo IS NOT NULL").select("item"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("SELECT u.item AS pagina, count(*) AS n FROM updates u WHERE NOT EXISTS (SELECT 1 FROM propositions p WHERE p.id=u.item) AND NOT EXISTS (SELECT 1 FROM laws l WHERE l.id=u.item) AND u.item IS NOT NULL GROUP BY 1")
def broken_links(spark, root):
    pages = table(spark, root, "propositions").select("id").union(table(spark, root, "laws").select("id"))
    return health.unresolved(table(spark, root, "updates"), "item", pages, "id").withColumnRenamed("item", "pagina")


@query("SELECT l.id, count(p.id) AS linhas FROM (SELECT DISTINCT id FROM laws) l LEFT JOIN laws p ON p.id=l.id GROUP BY 1 HAVING count(p.id)<>1")
def one_row_each(spark, root):
    laws = table(spark, root, "laws").select("id")
    return health.not_once(laws.distinct(), laws, "id")


@query("SELECT registro FROM atos WHERE contains(coalesce(url_oficial,''),'don.example') OR contains(coalesce(descricao,''),'don.example')")
def old_addresses(spark, root):
    return table(spark, root, "atos").where(F.coalesce(F.col("url_oficial").contains("don.example"), F.lit(False)) | F.coalesce(F.col("descricao").contains("don.example"), F.lit(False))).select("registro")


# --- measures and lists


@query("WITH r AS (SELECT id_execucao_primeira AS run, orgao, count(*) AS n, count(data) AS com FROM atos GROUP BY ALL) SELECT orgao, round(avg(100.0*com/n),1) AS cobertura, CAST(sum(n) AS BIGINT) AS vistos, count(*) FILTER (WHERE com<n) AS incompletas FROM r GROUP BY 1")
def mean_coverage(spark, root):
    r = table(spark, root, "atos").groupBy(F.col("id_execucao_primeira").alias("run"), "orgao").agg(F.count(F.lit(1)).alias("n"), F.count("data").alias("com"))
    return r.groupBy("orgao").agg(F.round(F.avg(100.0 * F.col("com") / F.col("n")), 1).alias("cobertura"), F.sum("n").alias("vistos"), F.count_if(F.col("com") < F.col("n")).alias("incompletas"))


@query("WITH r AS (SELECT id_execucao_primeira AS run, orgao, count(*) AS n FROM atos GROUP BY ALL) SELECT run, CAST(sum(n) AS BIGINT) AS chamadas, string_agg(orgao||'='||n, ';' ORDER BY orgao) AS por_orgao FROM r GROUP BY 1")
def calls_by_source(spark, root):
    r = table(spark, root, "atos").groupBy(F.col("id_execucao_primeira").alias("run"), "orgao").agg(F.count(F.lit(1)).alias("n"))
    m = r.groupBy("run").agg(F.sum("n").alias("chamadas"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("orgao", "n")))).alias("m"))  # a source per entry
    return m.select("run", "chamadas", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";").alias("por_orgao"))


@query("SELECT id_execucao AS run, count(*) AS mudancas, count(DISTINCT item) AS itens, count(*) FILTER (WHERE tipo='alteração de status') AS status, strftime(min(timestamp_execucao),'%H:%M:%S') AS inicio, CAST(epoch(max(timestamp_execucao)) - epoch(min(timestamp_execucao)) AS BIGINT) AS segundos FROM updates GROUP BY 1")
def run_counters(spark, root):
    at = F.unix_timestamp(F.col("timestamp_execucao").cast("timestamp"))
    return table(spark, root, "updates").groupBy(F.col("id_execucao").alias("run")).agg(
        F.count(F.lit(1)).alias("mudancas"), F.count_distinct("item").alias("itens"), F.count_if(F.col("tipo") == "alteração de status").alias("status"), F.date_format(F.min("timestamp_execucao"), "HH:mm:ss").alias("inicio"), (F.max(at) - F.min(at)).alias("segundos")
    )


@query("WITH a AS (SELECT registro, coalesce(canais,[]) AS c FROM atos) SELECT registro, array_to_string(list_sort(list_distinct(list_concat(c,['rss','api']))),',') AS unidos, len(list_distinct(list_concat(c,c))) AS distintos, array_to_string(list_slice(c,1,2),',') AS visiveis, greatest(len(c)-2,0) AS resto FROM a")
def channel_lists(spark, root):
    c = F.coalesce("canais", F.array().cast("array<string>"))
    a = table(spark, root, "atos").select("registro", c.alias("c"))
    more = F.array(F.lit("rss"), F.lit("api"))
    return a.select("registro", F.array_join(F.array_sort(F.array_union("c", more)), ",").alias("unidos"), F.size(F.array_distinct(F.concat("c", "c"))).cast("bigint").alias("distintos"), F.array_join(F.slice("c", 1, 2), ",").alias("visiveis"), F.size(F.slice("c", 3, 1000)).cast("bigint").alias("resto"))


@query("WITH w AS (SELECT DATE '2024-01-30' AS fim), e AS (SELECT CASE WHEN CAST(ts AS DATE) BETWEEN fim-6 AND fim THEN 'atual' WHEN CAST(ts AS DATE) BETWEEN fim-13 AND fim-7 THEN 'anterior' END AS janela, CAST(floor(epoch(ts)/604800) AS BIGINT) AS semana FROM events, w) SELECT janela, semana, count(*) AS n FROM e WHERE janela IS NOT NULL GROUP BY ALL")
def two_windows(spark, root):
    d, end = F.col("ts").cast("date"), F.lit("2024-01-30").cast("date")
    w = F.when(d.between(F.date_sub(end, 6), end), "atual").when(d.between(F.date_sub(end, 13), F.date_sub(end, 7)), "anterior")
    e = table(spark, root, "events").select(w.alias("janela"), dates.bucket(F.unix_timestamp(F.col("ts").cast("timestamp")), 604800).alias("semana")).where("janela IS NOT NULL")
    return e.groupBy("janela", "semana").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT update_id, '- ' || coalesce(data,'s/d') || ': ' || coalesce(titulo,'') || CASE WHEN anterior IS NOT NULL AND novo IS NOT NULL THEN ' (de “' || anterior || '” para “' || novo || '”)' ELSE '' END AS linha FROM updates")
def change_lines(spark, root):
    both = F.when(F.col("anterior").isNotNull() & F.col("novo").isNotNull(), F.concat(F.lit(" (de “"), "anterior", F.lit("” para “"), "novo", F.lit("”)"))).otherwise("")
    return table(spark, root, "updates").select("update_id", F.concat(F.lit("- "), F.coalesce("data", F.lit("s/d")), F.lit(": "), F.coalesce("titulo", F.lit("")), both).alias("linha"))


@query("WITH r AS (SELECT orgao, url_oficial AS url, row_number() OVER (PARTITION BY orgao ORDER BY url_oficial) AS n FROM (SELECT DISTINCT orgao, url_oficial FROM atos WHERE url_oficial IS NOT NULL)) SELECT orgao, url FROM r WHERE n<=2")
def probes(spark, root):
    a = table(spark, root, "atos").where("url_oficial IS NOT NULL").select("orgao", "url_oficial")
    two = F.slice(F.array_sort(F.collect_set("u")), 1, 2)
    low = a.groupBy("orgao", F.pmod(F.xxhash64("url_oficial"), F.lit(64)).alias("s")).agg(F.min("url_oficial").alias("m"))  # bounds the second pass: the two least are below two of these
    top = low.groupBy("orgao").agg(F.try_element_at(F.array_sort(F.collect_list("m")), F.lit(2)).alias("top"))
    near = a.join(top, "orgao").where(F.col("top").isNull() | (F.col("url_oficial") <= F.col("top"))).select("orgao", F.col("url_oficial").alias("u"))
    return near.groupBy("orgao").agg(two.alias("t")).select("orgao", F.explode("t").alias("url"))


def _shown(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


@query("SELECT update_id, item, regexp_extract(coalesce(novo,''),'(?i)(PL|PEC|PLP)\\s*(\\d{1,5})/(\\d{4})') AS alvo FROM updates WHERE (contains(lower(strip_accents(coalesce(titulo,'')||' '||coalesce(novo,''))),'arquivad') OR contains(lower(strip_accents(coalesce(titulo,'')||' '||coalesce(novo,''))),'apens')) AND NOT contains(lower(strip_accents(coalesce(novo,''))),'desapens') AND data_deteccao>'2024-06-30'")
def new_attachments(spark, root):
    u = table(spark, root, "updates").where("data_deteccao > '2024-06-30'").select("update_id", "item", "titulo", "novo")
    t = text.fold(F.concat_ws(" ", _shown(F.col("titulo")), _shown(F.col("novo"))))
    kept = u.where((t.contains("arquivad") | t.contains("apens")) & ~text.fold(F.col("novo")).contains("desapens"))
    return kept.select("update_id", "item", F.regexp_extract(_shown(F.col("novo")), r"(?i)(PL|PEC|PLP)\s*(\d{1,5})/(\d{4})", 0).alias("alvo"))
