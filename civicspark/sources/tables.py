"""Reading the Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Table ``name`` below ``root``: one Parquet file or a directory of them."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def spread(scan: DataFrame, most: int = 64) -> DataFrame:
    """A scan of a small table over all cores, for work in Python workers: a single small file is else one task.

    Scans with at least as many partitions as cores, as those of large tables, stay as they are.
    """
    cores = min(most, scan.sparkSession.sparkContext.defaultParallelism)
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
