"""Spark session helpers."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType


def get_spark(master: str | None = None, app: str = "corpusflow",
              shuffle_partitions: int | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    The master and memory come from spark-submit unless ``master`` or ``conf``
    name them.
    """
    builder = (
        SparkSession.builder
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is a shared folder set by whoever runs the cluster and is
    only read here.  Only when it is unset (local runs, tests) a private scratch
    folder is created and registered with the context.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return path
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    master = sc.master or ""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="corpusflow-ckpt-")
    sc.setCheckpointDir(path)
    return path


def materialised(df: DataFrame, as_types: dict[str, str | DataType] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage like ``checkpoint()``, which computes an uncached table twice
    and writes it uncompressed; later readers also get column pruning and sizes.
    ``as_types`` names columns to be read as another type, as Parquet holds them.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    schema = df.schema
    if as_types:
        schema = StructType([StructField(c.name, (DataType.fromDDL(t) if isinstance(t := as_types[c.name], str) else t) if c.name in as_types else c.dataType) for c in schema])
    return df.sparkSession.read.schema(schema).parquet(path)
