"""Readers for the input tables and reference-shaped views over them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# Tables whose rows carry long text: per-row work on them is CPU-heavy (regexes).
TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")


#: Session setting: spread text tables to at least this many partitions (unset: keep the scan's splits).
MIN_TEXT_SPLITS = "spark.corpusflow.minTextSplits"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; column pruning and filters reach the scan.

    A session may ask for a least number of partitions of the text tables
    (``MIN_TEXT_SPLITS``), for small files of one row group, whose regexes would
    otherwise run on one core.  It is off unless set.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    wanted = spark.conf.get(MIN_TEXT_SPLITS, None)
    if wanted and name in TEXT_TABLES:
        df = df.repartition(int(wanted))
    return df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def labelled_documents(spark: SparkSession, sf_dir: str, keywords: bool = False) -> DataFrame:
    """Documents shaped like the reference's raw table.

    ``transcription`` = text, ``description`` = source and language,
    ``sample_name`` = ``medical_specialty`` = source.  With ``keywords`` there is
    also that sparse column, from the labels table (one value per document, null
    where it has none); only then are labels read and joined.
    """
    docs = documents(spark, sf_dir)
    out = docs.select("doc_id", F.concat_ws(" ", "source", "lang").alias("description"),
                      F.col("source").alias("medical_specialty"), F.col("source").alias("sample_name"),
                      F.col("text").alias("transcription"), "lang")
    if not keywords:
        return out
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").cast("string").alias("keywords"))
    return out.join(labels, "doc_id", "left").select("doc_id", "description", "medical_specialty", "sample_name",
                                                     "transcription", "keywords", "lang")
