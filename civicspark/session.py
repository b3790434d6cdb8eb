"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for local work; on a cluster the submitter's settings hold instead."""
    b = (
        SparkSession.builder.master(master)
        .appName("civicspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; a local one only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.gettempdir() + "/civicspark-shared"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in the application's own part of it, for a table written by one call."""
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/civicspark-{spark.sparkContext.applicationId}"


def cleaned(spark: SparkSession) -> None:
    """Delete the tables this application has written to the shared folder. Results still unread are read from there: call it last."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut in the shared folder, so that a lost executor costs no recomputation."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: read back it carries no lineage and keeps column pruning."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shipped(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, so that functions run there import it by name and keep their caches."""
    sc = spark.sparkContext
    if getattr(sc, "_civicspark_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="civicspark-")) / "civicspark.zip"  # the driver serves it as long as the session lives
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._civicspark_shipped = True
    return spark
