"""Streaming queries, run to their end over the events and compared with the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import parsers
from ..sources.tables import table
from ..streaming import incremental


def stream_daily_counts(spark: SparkSession, root: str) -> DataFrame:
    """Events per day and type, counted by a stream."""
    s = incremental.parquet_stream(spark, f"{root}/events.parquet")
    return incremental.run_to_end(incremental.daily_counts(s, "ts", ["event_type"]), "daily", "complete")


def stream_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Each event once, by a stream that meets the table twice."""
    s = incremental.parquet_stream(spark, f"{root}/events.parquet")
    twice = s.select("event_id", "ts", "user_id").union(s.select("event_id", "ts", "user_id"))
    return incremental.run_to_end(incremental.without_repeats(twice, "ts", ["event_id"], "40 days"), "dedup").select("event_id", "user_id")


def stream_rate_limit(spark: SparkSession, root: str) -> DataFrame:
    """Users with more than one event in an hour, by a stream."""
    s = incremental.parquet_stream(spark, f"{root}/events.parquet")
    return incremental.run_to_end(incremental.limited(s, "ts", "user_id", "1 hour", 1), "limit", "complete").where("excedido").select("user_id", "janela", "n")


def parse_listing(spark: SparkSession, root: str) -> DataFrame:
    """Acts as a source would deliver them, a JSON listing per agency and day, read back into items."""
    a = table(spark, root, "atos").select("orgao", "data", F.struct(F.col("url_oficial").alias("url"), F.col("tipo"), F.col("titulo"), F.col("descricao"), F.col("data")).alias("x"))
    bodies = a.groupBy("orgao", "data").agg(F.to_json(F.struct(F.collect_list("x").alias("data"))).alias("corpo")).drop("data")
    items = parsers.all_items(bodies.withColumn("forma", F.lit("lista")), "forma", "corpo", ["lista"], ["orgao"])
    return items.groupBy("orgao").agg(F.count(F.lit(1)).alias("itens"), F.count_if(F.col("descricao") != "").alias("descritos"))


QUERIES = {f.__name__: f for f in (stream_daily_counts, stream_dedup, stream_rate_limit, parse_listing)}

SQL = {
    "stream_daily_counts": "SELECT strftime(ts,'%Y-%m-%d') AS dia, event_type, count(*) AS n FROM events GROUP BY ALL",
    "stream_dedup": "SELECT event_id, user_id FROM events",
    "stream_rate_limit": "SELECT user_id, strftime(date_trunc('hour',ts),'%Y-%m-%d %H:%M:%S') AS janela, count(*) AS n FROM events GROUP BY ALL HAVING count(*)>1",
    "parse_listing": "SELECT orgao, count(*) FILTER (WHERE trim(titulo)<>'') AS itens, count(*) FILTER (WHERE trim(titulo)<>'' AND trim(regexp_replace(coalesce(descricao,''),'<[^>]+>',' ','g'))<>'') AS descritos FROM atos GROUP BY 1",
}
