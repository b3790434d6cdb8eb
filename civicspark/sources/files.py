"""Datasets kept as whole JSON documents, and tables written so that a reader never meets a half-written one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def collection(spark: SparkSession, path: str, name: str, schema: StructType) -> DataFrame:
    """The rows of list ``name`` in a JSON document. A missing or unreadable document gives no rows."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    whole = StructType([StructField(name, ArrayType(schema)), StructField("_corrupt", StringType())])
    docs = spark.read.schema(whole).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return docs.select(F.explode(name).alias("r")).select("r.*")


def publish(df: DataFrame, path: str, mirrors: tuple[str, ...] = ()) -> str:
    """Write a new version of a table below ``path`` and then name it as current; the versions before stay readable. Mirrors get a copy
    of the same rows. Gives the version's folder."""
    spark = df.sparkSession
    version = f"{path}/v-{uuid.uuid4().hex}"
    df.write.parquet(version)
    for m in mirrors:
        spark.read.schema(df.schema).parquet(version).write.mode("overwrite").parquet(m)
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").json(f"{path}/current")
    return version


def current(spark: SparkSession, path: str) -> DataFrame:
    """The version named as current; one row of JSON tells which."""
    return spark.read.parquet(spark.read.schema("version string").json(f"{path}/current").first().version)
