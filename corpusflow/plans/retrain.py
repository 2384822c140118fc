"""The retraining job: quality gate, clean rows, features, training, validation, publication, notification.

Every step writes a table once and counts it while it writes (``observe``), so a
count costs no second pass.  Each step is a row of the run log; a failing gate
ends the job before the pointer to the serving model moves.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators import clean as cl
from corpusflow.operators import ml_chain as mc
from corpusflow.operators import profile as pr
from corpusflow.operators import score as sc
from corpusflow.plans import pipeline as pl
from corpusflow.sources import store

NOTICE_SCHEMA = "run_id string, job string, step_no int, step string, status string, value double, sent_at timestamp, message string"


def observed(df: DataFrame, path: str, **counts) -> tuple[dict, DataFrame]:
    """Write ``df`` and return what ``counts`` (name -> aggregate) were while it was written, and the written table."""
    seen = Observation(f"write-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()]).write.parquet(path)
    return seen.get, df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Retraining:
    run_id: str
    runs: store.RunLog
    registry: store.ModelRegistry
    folder: str
    status: str

    def notices(self) -> DataFrame:
        return self.runs.spark.read.schema(NOTICE_SCHEMA).parquet(f"{self.folder}/notices")


class GateFailed(Exception):
    pass


def retrain(spark: SparkSession, raw: DataFrame, folder: str, model: str = "multinomial_nb", job: str = "retrain", run_id: str | None = None,
            least_accuracy: float = 0.4, good_accuracy: float = 0.6, label_col: str = "lang") -> Retraining:
    """Run the job over ``raw`` (the library's document view); what it writes lies below ``folder``.

    ``status`` is ``published``, ``blocked`` (a gate said no; the serving model
    stays) or ``failed`` (a step raised; its row holds the error).  The last row
    is a notification in each case.
    """
    run_id = run_id or uuid.uuid4().hex
    runs, registry = store.RunLog(spark, f"{folder}/runs"), store.ModelRegistry(spark, folder)
    done = Retraining(run_id, runs, registry, folder, "failed")
    here = f"{folder}/work/{run_id}"
    result: dict = {}

    def check():
        gate = pr.data_quality_gate(raw, "transcription", "medical_specialty").first()
        if gate.status == "no_data":
            raise GateFailed("no rows to learn from")
        return gate.total_records, gate

    def clean():
        seen, table = observed(cl.clean_pipeline(raw), f"{here}/clean", chars=F.sum(F.length("transcription")))
        return seen["rows"], table

    def features(table: DataFrame):
        made = pl.build_features(pl.prepare_docs(table, label_col), persist=False)
        seen, rows = observed(mc.vector_rows(made, 5), f"{here}/rows", terms=F.sum(F.size("terms")))
        result["terms"] = seen["terms"]
        return seen["rows"], rows

    def train(rows: DataFrame):
        fitted = mc.chain(model).fit(rows.filter("fold <> 0"))
        return len(mc.feature_names(fitted)), fitted

    def validate(fitted, rows: DataFrame):
        held = fitted.transform(rows.filter("fold = 0")).select("doc_id", "label", "prediction")
        seen, _ = observed(held, f"{here}/predictions", correct=F.count_if(F.col("label") == F.col("prediction")))
        result["accuracy"] = seen["correct"] / max(1, seen["rows"])
        status = spark.range(1).select(sc.model_gate(F.lit(result["accuracy"]), least_accuracy, good_accuracy)).first()[0]
        if status == "failed":
            raise GateFailed(f"accuracy {result['accuracy']:.4f} is below {least_accuracy}")
        return result["accuracy"], status

    def publish(fitted):
        registry.publish(registry.save(fitted, run_id), run_id)
        return None, run_id

    try:
        runs.step(run_id, job, 1, "check_data_quality", check)
        table = runs.step(run_id, job, 2, "create_clean_dataset", clean)
        rows = runs.step(run_id, job, 3, "create_features", lambda: features(table))
        fitted = runs.step(run_id, job, 4, "train_model", lambda: train(rows))
        result["gate"] = runs.step(run_id, job, 5, "validate_model", lambda: validate(fitted, rows))
        runs.step(run_id, job, 6, "publish_model", lambda: publish(fitted))
        done.status = "published"
    except GateFailed as e:
        done.status, result["error"] = "blocked", str(e)
    except Exception as e:
        result["error"] = f"{type(e).__name__}: {e}"[:300]
    text = result.get("error") or f"accuracy {result['accuracy']:.4f}, {result['gate']}"
    notice = spark.createDataFrame([(run_id, job, 7, "notify", done.status, result.get("accuracy"), None, text)], NOTICE_SCHEMA)
    notice.withColumn("sent_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{folder}/notices")
    return done
