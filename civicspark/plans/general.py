"""The queries of the general problems on a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history, orphans, snapshots
from ..sources.tables import table

PROPOSITION_FIELDS = ("situacao", "comissao_atual", "relator")


def _points(spark: SparkSession, root: str) -> DataFrame:
    events = history.change_events(table(spark, root, "updates").select("item", "campo", "data", "timestamp_execucao", "update_id", "anterior", "novo"))
    laws = table(spark, root, "laws").select("id", "data", "status", "verificado_em").distinct()
    seen = laws.groupBy("id").agg(F.max(F.struct("verificado_em", "status", "data")).alias("x")).select(
        F.col("id").alias("item"), F.lit("status").alias("campo"), F.col("x.status").alias("valor"),
        F.date_format("x.verificado_em", "yyyy-MM-dd").alias("dia"), history.iso_day(F.col("x.data")).alias("inicio"),
    )
    props = table(spark, root, "propositions").select(F.col("id").alias("item"), history.iso_day(F.col("data_apresentacao")).alias("inicio"))
    starts = seen.select("item", "campo", "inicio").unionByName(
        props.select("item", F.explode(F.array(*map(F.lit, PROPOSITION_FIELDS))).alias("campo"), "inicio")
    )
    return history.attribute_points(events.where(F.col("campo").isin("status", *PROPOSITION_FIELDS)), starts, seen)


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """Versions of the attributes of laws and propositions."""
    return history.attribute_versions(_points(spark, root)).select("item", "campo", "valor", "valido_de", "valido_ate")


def p2_records(spark: SparkSession, root: str) -> DataFrame:
    """The same history by whole record: split at all boundary days, then coalesced."""
    return history.combined_history(p2_found(spark, root), ("status", *PROPOSITION_FIELDS))


def _orphans(spark: SparkSession, root: str) -> DataFrame:
    refs = orphans.exploded_references(table(spark, root, "parliamentarians"), "parliamentarians", "proposicoes_relacionadas").unionByName(
        orphans.exploded_references(table(spark, root, "laws"), "laws", "categorias")
    )
    span = lambda t, name: t.select(
        F.lit(name).alias("tabela"), F.lower(F.trim(F.col("id").cast("string"))).alias("ref"), F.col("incluida_em").alias("since"), F.col("removida_em").alias("until")
    )
    targets = span(table(spark, root, "propositions"), "parliamentarians").unionByName(span(table(spark, root, "categories"), "laws"))
    return orphans.orphan_references(refs, targets)


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    """References to propositions and categories that do not exist at the time of the referring row."""
    return _orphans(spark, root).select("tabela", "periodo", "id", "ref")


def p4_counts(spark: SparkSession, root: str) -> DataFrame:
    """Orphan references per table and month."""
    return orphans.orphan_counts(_orphans(spark, root))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """Records added, removed or changed in payload between consecutive snapshots."""
    return snapshots.snapshot_changes(table(spark, root, "commercial_records"))


def p5_counts(spark: SparkSession, root: str) -> DataFrame:
    """Changes per snapshot and kind."""
    return snapshots.change_counts(p5_found(spark, root))


QUERIES = {f.__name__: f for f in (p2_found, p2_records, p4_found, p4_counts, p5_found, p5_counts)}

_TRIM = "regexp_replace({0},'^\\s+|\\s+$','','g')"
_DAY = "CASE WHEN regexp_matches({0},'^\\s*\\d{{2}}/\\d{{2}}/\\d{{4}}\\s*$') THEN strftime(strptime(trim({0}),'%d/%m/%Y'),'%Y-%m-%d') ELSE left(trim({0}),10) END"

_VERSIONS = f"""
  l AS (SELECT DISTINCT id, data, status, verificado_em FROM laws),
  starts AS (SELECT id AS item, 'status' AS campo, data AS inicio FROM l
    UNION ALL SELECT id, f, data_apresentacao FROM propositions, (VALUES ('situacao'),('comissao_atual'),('relator')) t(f)),
  ev AS (SELECT u.item, lower({_TRIM.format("u.campo")}) AS campo, {_DAY.format("u.data")} AS dia, u.timestamp_execucao AS ts, u.update_id,
    nullif({_TRIM.format("u.anterior")},'') AS anterior, nullif({_TRIM.format("u.novo")},'') AS novo FROM updates u WHERE u.campo IS NOT NULL),
  mine AS (SELECT ev.*, s.inicio FROM ev JOIN starts s USING (item, campo)),
  daily AS (SELECT item, campo, inicio, dia, arg_max(novo,(ts,update_id)) AS valor FROM mine GROUP BY ALL),
  first AS (SELECT item, campo, any_value(inicio) AS dia, arg_min(anterior,(dia,ts,update_id)) AS valor FROM mine GROUP BY 1,2),
  logged AS (SELECT item, campo, 0 AS k, dia, valor FROM first UNION ALL SELECT item, campo, 1, dia, valor FROM daily),
  seen AS (SELECT l.id AS item, 'status' AS campo, CASE WHEN f.item IS NULL THEN 0 ELSE 2 END AS k,
    CASE WHEN f.item IS NULL THEN l.data ELSE strftime(l.verificado_em,'%Y-%m-%d') END AS dia, nullif({_TRIM.format("l.status")},'') AS valor
    FROM l LEFT JOIN (SELECT DISTINCT item FROM mine WHERE campo='status') f ON f.item=l.id),
  points AS (SELECT * FROM (SELECT *, lag(valor) OVER (PARTITION BY item, campo ORDER BY k, dia) AS b FROM
    (SELECT * FROM logged UNION ALL SELECT * FROM seen) WHERE valor IS NOT NULL) WHERE b IS DISTINCT FROM valor),
  versions AS (SELECT item, campo, valor, dia AS valido_de, coalesce(lead(dia) OVER (PARTITION BY item, campo ORDER BY k, dia),'') AS valido_ate FROM points)"""

_ORPHANS = f"""
  r AS (SELECT 'parliamentarians' AS tabela, id, registrado_em AS quando, lower({_TRIM.format("x")}) AS ref FROM
      (SELECT id, registrado_em, unnest(proposicoes_relacionadas) AS x FROM parliamentarians)
    UNION ALL SELECT 'laws', id, registrado_em, CAST(x AS VARCHAR) FROM (SELECT id, registrado_em, unnest(categorias) AS x FROM laws)),
  t AS (SELECT 'parliamentarians' AS tabela, id AS ref, incluida_em, removida_em FROM propositions
    UNION ALL SELECT 'laws', CAST(id AS VARCHAR), incluida_em, removida_em FROM categories),
  o AS (SELECT * FROM r WHERE coalesce(ref,'')<>'' AND NOT EXISTS (SELECT 1 FROM t WHERE t.tabela=r.tabela AND t.ref=r.ref
    AND t.incluida_em<=r.quando AND (t.removida_em IS NULL OR t.removida_em>r.quando)))"""

_CHANGES = """
  c AS (SELECT snapshot_dia, kind, id, arg_max(payload, updated_at) AS payload FROM commercial_records GROUP BY ALL),
  j AS (SELECT snapshot_dia, kind, id, (SELECT list(e.fullkey || ':' || CASE WHEN e.type IN ('UBIGINT','BIGINT','DOUBLE') THEN CAST(CAST(CAST(e.atom AS VARCHAR) AS DOUBLE) AS VARCHAR)
    ELSE e.type || coalesce(CAST(e.atom AS VARCHAR),'') END ORDER BY e.fullkey) FROM json_tree(payload) e) AS v FROM c),
  d AS (SELECT snapshot_dia AS dia, lead(snapshot_dia) OVER (ORDER BY snapshot_dia) AS prox FROM (SELECT DISTINCT snapshot_dia FROM c)),
  o AS (SELECT d.prox AS snapshot_dia, kind, id, v FROM j JOIN d ON dia=snapshot_dia WHERE prox IS NOT NULL),
  n AS (SELECT * FROM j WHERE snapshot_dia > (SELECT min(dia) FROM d)),
  x AS (SELECT coalesce(n.snapshot_dia,o.snapshot_dia) AS snapshot_dia, coalesce(n.kind,o.kind) AS kind, coalesce(n.id,o.id) AS id,
    CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN o.v IS DISTINCT FROM n.v THEN 'changed' END AS mudanca
    FROM n FULL JOIN o ON n.snapshot_dia=o.snapshot_dia AND n.kind=o.kind AND n.id=o.id)"""

_FIELDS = ("status", *PROPOSITION_FIELDS)
_RECORDS = f"""
  p AS (SELECT item, valido_de AS dia, {", ".join(f"max(CASE WHEN campo='{f}' THEN valor END) AS {f}" for f in _FIELDS)} FROM versions GROUP BY 1,2),
  h AS (SELECT item, dia, {", ".join(f"last_value({f} IGNORE NULLS) OVER (PARTITION BY item ORDER BY dia ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {f}" for f in _FIELDS)} FROM p),
  k AS (SELECT * FROM (SELECT *, row_number() OVER w AS n, {", ".join(f"lag({f}) OVER w AS b_{f}" for f in _FIELDS)} FROM h WINDOW w AS (PARTITION BY item ORDER BY dia))
    WHERE n=1 OR {" OR ".join(f"b_{f} IS DISTINCT FROM {f}" for f in _FIELDS)})"""

SQL = {
    "p2_records": f"WITH {_VERSIONS}, {_RECORDS} SELECT item, dia AS valido_de, coalesce(lead(dia) OVER (PARTITION BY item ORDER BY dia),'') AS valido_ate, {', '.join(_FIELDS)} FROM k",
    "p2_found": f"WITH {_VERSIONS} SELECT * FROM versions",
    "p4_found": f"WITH {_ORPHANS} SELECT DISTINCT tabela, strftime(quando,'%Y-%m') AS periodo, id, ref FROM o",
    "p4_counts": f"WITH {_ORPHANS} SELECT tabela, strftime(quando,'%Y-%m') AS periodo, count(DISTINCT id) AS linhas, count(*) AS referencias, count(DISTINCT ref) AS alvos FROM o GROUP BY ALL",
    "p5_found": f"WITH {_CHANGES} SELECT * FROM x WHERE mudanca IS NOT NULL",
    "p5_counts": f"WITH {_CHANGES} SELECT snapshot_dia, kind, count(*) FILTER (WHERE mudanca='added') AS added, count(*) FILTER (WHERE mudanca='removed') AS removed, count(*) FILTER (WHERE mudanca='changed') AS changed FROM x WHERE mudanca IS NOT NULL GROUP BY ALL",
}
