"""Tables on disk: CSV scan, table sink, feature store, model store and run log.

Folders are given by the caller and must be shared by all executors.  Every
table is Parquet unless asked otherwise.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.operators.models import NBModel

#: How CSV files are written and read: quoted fields may hold line ends; an empty text differs from a null.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": "",
               "lineSep": "\n", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str, schema: str | None = None, lines_in_fields: bool = True) -> DataFrame:
    """CSV with a header; without ``schema`` every column is a string.

    Fields with line ends keep a file from being split, so a file is one task and
    its rows are dealt out anew right after the scan.  Pass
    ``lines_in_fields=False`` for files without such fields: Spark splits those.
    """
    reader = spark.read.options(**CSV_OPTIONS | {"multiLine": str(lines_in_fields).lower()})
    rows = (reader.schema(schema) if schema else reader).csv(path)
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))) if lines_in_fields else rows


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                partition_by: tuple[str, ...] = ()) -> str:
    """Write ``df`` as ``parquet``, ``csv`` or ``json``; returns ``path``."""
    if fmt == "csv":
        options = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"} | {"quoteAll": "true"}
    else:
        options = {}
    df.write.format(fmt).mode(mode).options(**options).partitionBy(*partition_by).save(path)
    return path


FEATURE_TABLES = ("vocab", "tfidf", "dense", "matrix", "labels")


class FeatureStore:
    """The fitted feature tables below one folder, one sub-folder per table.

    Tables with a row key are cut into ``buckets`` by ``doc_id`` and sorted by it,
    so joins and groupings on ``doc_id`` between them move nothing.  How a table
    was cut is kept beside it, and a later session declares it from there.
    """

    KEY = "doc_id"

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _table(self, name: str) -> str:
        return f"feature_store_{hashlib.md5(self.folder.encode()).hexdigest()[:16]}_{name}"

    def save(self, features, tables: tuple[str, ...] = FEATURE_TABLES) -> "FeatureStore":
        for name in tables:
            self.put(name, getattr(features, name))
        return self

    def put(self, name: str, df: DataFrame) -> None:
        path, keyed = f"{self.folder}/{name}", self.KEY in df.columns
        if keyed:  # one file per bucket
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
            (df.repartition(self.buckets, self.KEY).write.mode("overwrite").format("parquet").option("path", path)
             .bucketBy(self.buckets, self.KEY).sortBy(self.KEY).saveAsTable(self._table(name)))
        else:
            df.write.mode("overwrite").parquet(path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        layout = self.spark.createDataFrame([(columns, self.buckets if keyed else 0)], "columns string, buckets int")
        layout.coalesce(1).write.mode("overwrite").json(f"{self.folder}/_layout_{name}")

    def load(self, name: str) -> DataFrame:
        layout = self.spark.read.schema("columns string, buckets int").json(f"{self.folder}/_layout_{name}").first()
        if not layout.buckets:
            return self.spark.read.parquet(f"{self.folder}/{name}")
        if not self.spark.catalog.tableExists(self._table(name)):
            self.spark.sql(f"CREATE TABLE {self._table(name)} ({layout.columns}) USING parquet CLUSTERED BY ({self.KEY}) SORTED BY ({self.KEY}) "
                           f"INTO {layout.buckets} BUCKETS LOCATION '{self.folder}/{name}'")
        return self.spark.table(self._table(name))


def save_nb(model: NBModel, folder: str) -> str:
    """Write a naive Bayes model: class table, deltas and, for complement NB, the feature constants."""
    model.classes.write.mode("overwrite").parquet(f"{folder}/classes")
    model.deltas.write.mode("overwrite").parquet(f"{folder}/deltas")
    if model.feature_const is not None:
        model.feature_const.write.mode("overwrite").parquet(f"{folder}/feature_const")
    return folder


def load_nb(spark: SparkSession, folder: str, complement: bool = False) -> NBModel:
    classes = spark.read.parquet(f"{folder}/classes")
    const = spark.read.parquet(f"{folder}/feature_const") if complement else None
    return NBModel(spark.read.parquet(f"{folder}/deltas"), classes, const, classes.select(F.count(F.lit(1))).scalar())


POINTER_SCHEMA = "version string, run_id string, published_at timestamp"


class ModelRegistry:
    """Fitted pipelines below one folder, one sub-folder per version, and an append-only table that names the serving one.

    A version is written whole before it can be published, and publishing appends
    one file to the pointer table, so readers see the old version or the new one.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def save(self, model: PipelineModel, version: str) -> str:
        model.write().save(f"{self.folder}/models/{version}")
        return version

    def load(self, version: str | None = None) -> PipelineModel:
        return PipelineModel.load(f"{self.folder}/models/{version or self.serving()}")

    def publish(self, version: str, run_id: str | None = None) -> None:
        row = self.spark.createDataFrame([(version, run_id, None)], POINTER_SCHEMA).withColumn("published_at", F.current_timestamp())
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/pointer")

    def published(self) -> DataFrame:
        """All rows of the pointer table; none before the first publication."""
        try:
            return self.spark.read.schema(POINTER_SCHEMA).parquet(f"{self.folder}/pointer")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], POINTER_SCHEMA)

    def serving(self) -> str | None:
        """The version published last; None before the first publication."""
        newest = self.published().orderBy(F.desc("published_at"), F.desc("version")).first()
        return newest.version if newest else None


RUN_SCHEMA = "run_id string, job string, step_no int, step string, status string, value double, finished_at timestamp, message string"


@dataclass
class RunLog:
    """An append-only table with one row per finished step."""

    spark: SparkSession
    path: str

    def append(self, run_id: str, job: str, step_no: int, step: str, status: str, value=None, message: str | None = None) -> None:
        row = self.spark.createDataFrame([(run_id, job, step_no, step, status, None if value is None else float(value), None, message)], RUN_SCHEMA)
        row.withColumn("finished_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)

    def step(self, run_id: str, job: str, step_no: int, step: str, fn):
        """Run ``fn() -> (value, result)`` and log success, or failure with its message, which is raised again."""
        try:
            value, result = fn()
        except Exception as e:
            self.append(run_id, job, step_no, step, "failed", message=str(e)[:500])
            raise
        self.append(run_id, job, step_no, step, "success", value)
        return result

    def table(self) -> DataFrame:
        return self.spark.read.schema(RUN_SCHEMA).parquet(self.path)

    def history(self, last: int = 10) -> DataFrame:
        """The newest ``last`` runs of every job: steps, failures and the last step's name."""
        runs = self.table().groupBy("job", "run_id").agg(
            F.count(F.lit(1)).alias("steps"), F.count_if(F.col("status") == "failed").alias("failed"),
            F.max("finished_at").alias("finished_at"), F.max_by("step", "step_no").alias("last_step"))
        newest = Window.partitionBy("job").orderBy(F.desc("finished_at"), F.desc("run_id"))
        return runs.withColumn("age", F.row_number().over(newest)).filter(F.col("age") <= last)
