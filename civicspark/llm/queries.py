"""The queries of the text problems on a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import written
from ..sources.tables import spread, table
from . import bpe, languages, mixing, names, repeats, truncation


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of parliamentarians' records that name one person."""
    return names.person_pairs(names.persons(table(spark, root, "parliamentarians")))


def _truncated(spark: SparkSession, root: str) -> DataFrame:
    return truncation.truncated(spread(table(spark, root, "atos").select("registro", "orgao", "titulo", "descricao")))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """Titles and descriptions of acts of which the end is missing."""
    return _truncated(spark, root).where("sign IS NOT NULL").selectExpr("id AS registro", "campo").distinct()


def p3_shares(spark: SparkSession, root: str) -> DataFrame:
    """The share of cut values per source and field."""
    return truncation.truncation_shares(_truncated(spark, root))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """Acts that repeat the text of an earlier row, with the first row of it; each run is a batch of its own."""
    rows = spread(table(spark, root, "atos").select("registro", "id_execucao_primeira", "titulo", "descricao"))
    return repeats.InvertedFile(spark).accept(rows, "id_execucao_primeira").selectExpr("root AS registro_a", "row AS registro_b")


def p7_ids(spark: SparkSession, root: str) -> DataFrame:
    """The token ids of every document."""
    return bpe.encoded(spread(table(spark, root, "documents").select("doc_id", "text")))


def p8_mix(spark: SparkSession, root: str) -> DataFrame:
    """How often each document occurs in the mix."""
    counts = written(bpe.token_counts(spread(table(spark, root, "documents").select("doc_id", "source", "text")), ["doc_id", "source"]), "token-counts")
    return mixing.mixed(counts, table(spark, root, "mix_targets"))


def p8_shares(spark: SparkSession, root: str) -> DataFrame:
    """The shares reached, by source."""
    return mixing.reached_shares(p8_mix(spark, root), table(spark, root, "mix_targets"))


def _languages(spark: SparkSession, root: str) -> DataFrame:
    docs = spread(table(spark, root, "documents").select("doc_id", "text", "lang"))
    read = languages.parsed(docs)
    return languages.languages_of(read, languages.trained_on(read)).withColumnRenamed("id", "doc_id")


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    """The languages of every document whose label is missing or wrong."""
    return languages.mislabelled(_languages(spark, root))


def p9_documents(spark: SparkSession, root: str) -> DataFrame:
    """Every document with its languages, their shares and a confidence."""
    return _languages(spark, root).select("doc_id", "lang", "share", "confidence")


def p9_segments(spark: SparkSession, root: str) -> DataFrame:
    """Every stretch of every document with its language and a confidence."""
    return languages.segments(_languages(spark, root))


QUERIES = {f.__name__: f for f in (p1_found, p3_found, p3_shares, p6_found, p7_ids, p8_mix, p8_shares, p9_found, p9_documents, p9_segments)}
