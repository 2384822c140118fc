import os
import random

import pytest
from corpusflow.operators import features as fe
from corpusflow.operators import ml_chain as mc
from corpusflow.operators import sketches as sk
from corpusflow.plans import queries
from corpusflow.session import ensure_checkpoint_dir
from corpusflow.sources.tables import read_table
from corpusflow.streaming import score_stream as ss
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from test_queries_small import SF

SCHEMA = StructType().add("conv_id", "long").add("turn", "long").add("text", "string")


@pytest.fixture(scope="module")
def trained(spark):
    ensure_checkpoint_dir(spark)
    f = queries._features(spark, SF)
    return f, mc.chain("multinomial_nb", k=50).fit(mc.vector_rows(f).checkpoint()), fe.label_index(f.docs, "sample_name", null_as="unknown")


def test_parsing_and_rejects(spark):
    lines = ['{"conv_id":1,"turn":2,"text":"good text"}', '{"conv_id":1,"turn":', "no json", "", '{"conv_id":"x","turn":1,"text":"t"}', '{"conv_id":2,"turn":1,"text":null}',
             '{"conv_id":2,"turn":2,"text":""}', '{"conv_id":2,"turn":3,"text":" \\t "}', '{"conv_id":1000,"turn":1000,"text":"ok","more":1}', "null", "[1]"]
    valid, rejects = ss.split(ss.parsed(spark.createDataFrame([(x,) for x in lines], "value string"), SCHEMA))
    assert sorted((r.conv_id, r.turn) for r in valid.collect()) == [(1, 2), (1000, 1000)]
    got = {r.raw: r.reason for r in rejects.collect()}
    assert len(got) == len(lines) - 2  # no line is lost
    assert [got[lines[k]] for k in (1, 2, 3, 4)] == ["corrupt"] * 4 and [got[lines[k]] for k in (5, 6, 7)] == ["null", "empty", "blank"]


def test_serving_vectors_are_those_of_training(spark, trained):
    f, model, index = trained
    texts = f.docs.select("doc_id", F.col("transcription").alias("text"))
    served = ss.serving_rows(texts, index)
    assert served.select("doc_id", "terms").exceptAll(f.term_rows.join(texts.select("doc_id"), "doc_id")).isEmpty()
    own = [c for c in mc.DENSE if not c.startswith("description") and c not in ("text_length_ratio", "sample_name_encoded")]
    assert served.select("doc_id", *own).exceptAll(f.dense.select("doc_id", *own)).isEmpty()


def test_epochs_restart_and_replay(spark, trained, tmp_path):
    _, model, index = trained
    turns = read_table(spark, SF, "conversations").select("conv_id", "turn", "text").limit(30)
    lines = [r.value for r in turns.select(F.to_json(F.struct("*")).alias("value")).collect()]
    put = lambda name, part: (tmp_path / name).write_text("\n".join(part) + "\n")
    (tmp_path / "in").mkdir()
    put("in/a.txt", [*lines[:10], "broken"])
    run = f"t{os.getpid()}-{tmp_path.name}"

    def go():
        scores, rejects = ss.score_lines(ss.line_stream(spark, f"{tmp_path}/in", 1), SCHEMA, F.struct("conv_id", "turn"), model, index, run)
        return (sorted((r.doc_id.conv_id, r.doc_id.turn, r.pred_class_id, round(r.confidence, 9)) for r in scores.collect()),
                sorted((r.raw, r.reason) for r in rejects.collect()))

    first, bad = go()
    assert len(first) == 10 and bad == [("broken", "corrupt")]
    put("in/b.txt", ['{"conv_id":', *lines[10:]])
    second, bad = go()  # goes on after the first file
    assert len(second) == 30 and bad == [("broken", "corrupt"), ('{"conv_id":', "corrupt")] and set(first) <= set(second)
    for name in ("1", ".1.crc"):  # as if the driver was lost before the commit
        os.unlink(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/streams/scored-{run}/commits/{name}")
    assert go() == (second, bad)
    batch = ss.scored(turns.withColumn("doc_id", F.struct("conv_id", "turn")), model, index).collect()
    assert second == sorted((r.doc_id.conv_id, r.doc_id.turn, r.pred_class_id, round(r.confidence, 9)) for r in batch)


def test_sketches_merge_within_their_error(spark):
    rng = random.Random(6)
    rows = [(h, "/hot" if rng.random() < 0.6 else "/b", rng.randrange(4_000), 500 if rng.random() < 0.1 else 200, rng.lognormvariate(3, 1)) for h in range(6) for _ in range(4_000)]
    log = spark.createDataFrame(rows, "h int, endpoint string, user_agent int, status_code int, response_time_ms double")
    log = log.withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("h") * 3600)).withColumn("user_agent", F.col("user_agent").cast("string"))
    table = sk.hourly_sketches(log).persist()
    assert table.count() == 12
    for lo, hi in ((0, 6), (2, 4)):
        own = [r for r in rows if lo <= r[0] < hi]
        for r in sk.merged(table, f"2024-01-01 0{lo}:00:00", f"2024-01-01 0{hi}:00:00").collect():
            mine = [x for x in own if x[1] == r.endpoint]
            times = sorted(x[4] for x in mine)
            assert (r.requests, r.errors) == (len(mine), sum(x[3] >= 400 for x in mine))
            assert abs(r.clients / len({x[2] for x in mine}) - 1) < 0.05
            for p, v in ((0.5, r.p50), (0.95, r.p95), (0.99, r.p99)):
                assert abs(sum(t <= v for t in times) / len(times) - p) < 0.03
    whole = sk.merged(table, by=()).first()
    assert whole.requests == len(rows)
    assert sk.merged(table.limit(0)).count() == 0
