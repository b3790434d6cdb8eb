"""Structured Streaming forms of the incremental operators: counts per day, late and repeated events, upserts and limits per window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import first_wins
from ..session import scratch_path, written


def parquet_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A Parquet file, or a folder of them, as a stream; ``files_per_trigger`` bounds what one batch takes in."""
    schema = spark.read.parquet(path).schema
    pattern = f"{path[:-1]}[{path[-1]}]"  # as a pattern the path may be a single file as well
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(pattern)


def timed(stream: DataFrame, at: str, late: str = "1 day") -> DataFrame:
    """``at`` as a timestamp with a watermark: rows later than ``late`` behind the newest are dropped by stateful steps."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)


def daily_counts(stream: DataFrame, at: str, by: list[str]) -> DataFrame:
    """(dia, *by, n) per day of event time."""
    return timed(stream, at).groupBy(F.window(at, "1 day").alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.date_format("w.start", "yyyy-MM-dd").alias("dia"), *by, "n")


def without_repeats(stream: DataFrame, at: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """The first row of each key; keys are remembered for ``late`` of event time, so the state stays bounded."""
    return timed(stream, at, late).dropDuplicatesWithinWatermark(keys)


def limited(stream: DataFrame, at: str, key: str, width: str, most: int) -> DataFrame:
    """(key, janela, n, excedido): requests per key and fixed window, and whether they exceed the limit."""
    g = timed(stream, at).groupBy(F.window(at, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return g.select(key, F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("janela"), "n", (F.col("n") > most).alias("excedido"))


def run_to_end(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All that is there now, batch by batch, into a table in the shared folder; the result as a batch.

    In complete mode each batch's whole result replaces the one before. Each batch is written under its number, so a batch that is tried again
    replaces itself.
    """
    spark = stream.sparkSession
    out, mark = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-mark")
    last: dict[str, int] = {}

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        last["n"] = number

    q: StreamingQuery = stream.writeStream.outputMode(mode).option("checkpointLocation", mark).trigger(availableNow=True).foreachBatch(put).start()
    q.awaitTermination()
    if not last:
        return spark.createDataFrame([], stream.schema)
    return spark.read.parquet(f"{out}/batch={last['n']}") if mode == "complete" else spark.read.parquet(out).drop("batch")


def _parts(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """The newest part of each bucket, of batches below ``before``; empty where nothing is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/upsert_bucket=*/upsert_part=*")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
    out: dict[int, int] = {}
    for f in found:
        bucket, v = (int(x.rpartition("=")[2]) for x in str(f.getPath().toString()).rsplit("/", 2)[1:])
        if before is None or v < before:
            out[bucket] = max(v, out.get(bucket, -1))
    return out


def upserted(spark: SparkSession, path: str) -> DataFrame:
    """The table that upsert_stream() keeps at ``path``."""
    parts = [f"{path}/upsert_bucket={b}/upsert_part={v}" for b, v in sorted(_parts(spark, path).items())]
    return spark.read.option("basePath", path).parquet(*parts).drop("upsert_bucket", "upsert_part")


def upsert_stream(stream: DataFrame, path: str, keys: list[str], version: str, buckets: int = 64) -> StreamingQuery:
    """Keep the latest row per key in a table at ``path``, read by upserted(). Keys lie in ``buckets`` by hash, and a batch rewrites the buckets it touches only, each under
    the number of the batch: a batch tried again rewrites its own part from the ones before, and untouched buckets are not read."""
    spark = stream.sparkSession

    def put(batch: DataFrame, number: int) -> None:
        newest = first_wins(batch, keys, [F.col(version).desc_nulls_last()]).withColumn("upsert_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        newest = written(newest, "upsert")
        touched = [r.upsert_bucket for r in newest.select("upsert_bucket").distinct().collect()]  # buckets at most
        held = _parts(spark, path, number)
        old = [f"{path}/upsert_bucket={b}/upsert_part={held[b]}" for b in touched if b in held]
        if old:
            before = spark.read.option("basePath", path).parquet(*old).drop("upsert_part")
            newest = first_wins(before.unionByName(newest), keys, [F.col(version).desc_nulls_last()])
        newest.repartition("upsert_bucket").withColumn("upsert_part", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("upsert_bucket", "upsert_part").parquet(path)

    return stream.writeStream.option("checkpointLocation", f"{path}-mark").trigger(availableNow=True).foreachBatch(put).start()
