"""Session defaults and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tablebridge.model import SourceError

CHECKPOINT_KEY = "spark.checkpoint.dir"
CODEC = "zstd"  # of staged tables: they stay until the application's folder goes, so they should be small


def local_session(cpus: int | str = "*", app: str = "tablebridge", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.fileCompressionFactor", "3.0")  # Parquet is smaller than its rows
        .config("spark.driver.memory", "16g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting: it then gets a folder of
    its own, because driver and executors are one machine.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise SourceError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="tablebridge-")
    spark.conf.set(CHECKPOINT_KEY, fallback)
    return fallback


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tablebridge/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy cuts the lineage, survives lost executors and is columnar, so a
    later pass over one column reads only that column.
    """
    path = staging_path(df.sparkSession, label)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
