"""Scoring a stream of JSON lines with a stored model: valid rows to one table, all others to a reject table with their reason.

Every epoch writes both tables into folders of its own, so a replayed epoch
replaces what it wrote.  Texts go through the same feature operators as in
training, and the model is the pipeline that was fitted on them.
"""
from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import text as tx
from corpusflow.operators import clean as cl
from corpusflow.operators import features as fe
from corpusflow.session import ensure_checkpoint_dir

CORRUPT = "_corrupt"


def line_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files below ``folder`` as a stream with one column, ``value``."""
    reader = spark.readStream
    return (reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else reader).text(folder)


def parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` and ``raw``, the line itself; ``_corrupt`` holds a line that is no JSON object of that schema."""
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.select(F.col("value").alias("raw"), record.alias("r")).select("raw", "r.*")
    # An empty line gives no record at all.
    nothing = F.coalesce(*[F.col(f.name).isNotNull() for f in schema.fields[:1]]) | F.col(CORRUPT).isNotNull()
    return rows.withColumn(CORRUPT, F.when(~nothing & (F.trim("raw") == ""), F.col("raw")).otherwise(F.col(CORRUPT)))


def serving_rows(texts: DataFrame, sample_index: DataFrame, ngram=(1, 2)) -> DataFrame:
    """``doc_id`` and ``text`` to the terms and dense columns that a chain of ``ml_chain`` reads; ``doc_id`` may be a struct."""
    docs = texts.select("doc_id", F.lit(None).cast("string").alias("sample_name"), F.lit(None).cast("string").alias("description"),
                        tx.clean_text(F.col("text")).alias("transcription"))
    docs = docs.withColumn("transcription_cleaned", tx.normalize_conservative(F.col("transcription")))
    terms = fe.term_arrays(docs, "transcription_cleaned", ngram=ngram, stop_words=fe.english_stop_words())
    dense = fe.dense_features(docs, sample_index, serving=True)
    return terms.join(dense, "doc_id")


def scored(texts: DataFrame, model: PipelineModel, sample_index: DataFrame) -> DataFrame:
    """(doc_id, pred_class_id, confidence) of every text."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(serving_rows(texts, sample_index))
    top = F.array_max(vector_to_array("probability"))
    return out.select("doc_id", F.col("prediction").cast("int").alias("pred_class_id"), top.alias("confidence"))


REJECTS = "raw string, reason string"


def split(rows: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows with a usable text, and (raw, reason) of the others: ``corrupt``, ``null``, ``empty`` or ``blank``."""
    valid, bad = cl.valid_text(rows.filter(F.col(CORRUPT).isNull()), text_col)
    corrupt = rows.filter(F.col(CORRUPT).isNotNull()).select("raw", F.lit("corrupt").alias("reason"))
    return valid.drop(CORRUPT), corrupt.unionByName(bad.select("raw", F.col("reject_reason").alias("reason")))


def score_lines(lines: DataFrame, schema: T.StructType, doc_id: Column, model: PipelineModel, sample_index: DataFrame,
                run: str | None = None, trigger: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Score everything available; returns the tables of scores and rejects, written so far under this ``run``."""
    spark = lines.sparkSession
    base, run = ensure_checkpoint_dir(spark), run or uuid.uuid4().hex
    out = f"{base}/tables/scored-{run}"

    def sink(batch: DataFrame, epoch: int) -> None:
        # Both tables read the batch.
        batch = parsed(batch, schema).persist()
        valid, rejects = split(batch)
        scored(valid.withColumn("doc_id", doc_id), model, sample_index).write.mode("overwrite").parquet(f"{out}/scores/epoch={epoch}")
        rejects.write.mode("overwrite").parquet(f"{out}/rejects/epoch={epoch}")
        batch.unpersist()

    query = (lines.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/streams/scored-{run}")
             .trigger(**(trigger or {"availableNow": True})).start())
    query.awaitTermination()
    return (spark.read.option("basePath", f"{out}/scores").parquet(f"{out}/scores"),
            spark.read.option("basePath", f"{out}/rejects").parquet(f"{out}/rejects"))
