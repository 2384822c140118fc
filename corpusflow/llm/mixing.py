"""Mixing sources to target weights [native]: iterative proportional fitting.

Tokens are summed per cell (source, language, topic).  Raking scales the cell
weights to each target marginal in turn, for a fixed number of rounds; a cell's
documents are then sampled with the probability that brings the cell's expected
tokens to its weight.  Cells whose probability would pass 1 are kept whole and
what they cannot give is spread over the other cells (``spread_rounds`` times).

The text table is scanned twice (once if only the decisions are asked for) and
never shuffled: only cell sums move, and they are summed in every task before
they do.

Defined cases: a null source, language or text form is a category of its own,
``(none)``; tokens are the words ``[^\\x20\\x09-\\x0D]+``; documents without a word
have no weight and are all kept, since they change no total; a category that
the targets do not name gets the share 0; shares that do not sum to 1 are
scaled; a target category without tokens is unreachable, and its share goes to
the others; repeated rows of a doc_id share one draw; an empty table gives an
empty result.  Marginals that no weights of the present cells can meet (for
instance a language that only one source has) are met as closely as raking
comes in ``rounds`` rounds; the last dimension raked is met exactly.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import beside, read, stored

DIMS = ("source", "lang", "topic")
#: Production parameters: share of all tokens to keep; exponent that flattens each marginal; rounds.
RATE, FLATTEN, ROUNDS, SPREAD_ROUNDS, SEED = 0.5, {"source": 0.5, "lang": 0.7, "topic": 0.8}, 10, 4, "mix-1"


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t-\r]+")).cast("long")


def text_form(text: Column, words: Column) -> Column:
    """The default topic: which kind of page the text is laid out as."""
    body = F.coalesce(text, F.lit(""))
    symbols = F.char_length(body) - F.char_length(F.translate(body, "#*$%&<>", ""))
    pipes = F.char_length(body) - F.char_length(F.translate(body, "|", ""))
    lines = F.char_length(body) - F.char_length(F.translate(body, "\n", "")) + 1
    return (F.when(words == 0, "empty").when(pipes * 5 > words, "table").when(symbols * 5 > words, "symbols")
            .when(lines * 12 > words, "short lines").when(words >= 1000, "long prose").otherwise("prose"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the document and the seed alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def flattened(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Target shares of one dimension: its token shares to ``power``, scaled to sum to 1."""
    sums = cells.groupBy(dim).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("t"))
    return sums.select(dim, F.col("t").alias("target"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Cells with ``weight``: shares of the mixture that meet the target marginals, summing to 1.

    ``cells`` has the dimensions and ``tokens`` (above 0); each table of
    ``targets`` has its dimension and ``target`` (any positive scale).
    """
    dims = list(targets)
    for d in dims:
        t = targets[d].select(F.col(d).alias("__d"), F.col("target").cast("double").alias(f"__t_{d}"))
        cells = cells.join(t, F.col(d) == F.col("__d"), "left").drop("__d").fillna(0.0, [f"__t_{d}"])
    cells = stored(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    for k in range(rounds):
        for d in dims:
            total = F.sum("weight").over(Window.partitionBy(d))
            cells = cells.withColumn("weight", F.when(total > 0, F.col("weight") * F.col(f"__t_{d}") / total).otherwise(0.0))
        if k % 5 == 4:
            cells = stored(cells, "raked")
    cells = stored(cells, "raked")
    total = cells.agg(F.sum("weight").alias("s")).select("s").scalar()
    return cells.withColumn("weight", F.col("weight") / total).drop(*[f"__t_{d}" for d in dims])


def probabilities(cells: DataFrame, rate: float = RATE, spread_rounds: int = SPREAD_ROUNDS) -> DataFrame:
    """Cells with ``probability``: expected tokens in proportion to ``weight``, ``rate`` of all tokens together."""
    cells = stored(cells, "weighted")
    budget = cells.agg((F.sum("tokens") * F.lit(rate)).alias("b")).select("b").scalar()
    cells = cells.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * budget / F.col("tokens")))
    for _ in range(spread_rounds):
        cells = stored(cells, "spread")
        full = F.col("probability") >= 1.0
        sums = cells.agg(F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)).alias("taken"),
                         F.sum(F.when(~full, F.col("weight"))).alias("open"))
        rest = budget - sums.select("taken").scalar()
        open_ = sums.select("open").scalar()
        cells = cells.withColumn("probability", F.when(full, 1.0).otherwise(
            F.least(F.lit(1.0), F.coalesce(F.col("weight") * rest / F.nullif(open_, F.lit(0.0)) / F.col("tokens"), F.lit(0.0)))))
    return stored(cells, "probabilities")


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float] | DataFrame] | None = None, rate: float = RATE,
        rounds: int = ROUNDS, spread_rounds: int = SPREAD_ROUNDS, seed: str = SEED, topic: Column | None = None,
        flatten: Mapping[str, float] | None = None, narrow: bool = False) -> DataFrame:
    """``docs`` with ``__tokens``, ``__source``, ``__lang``, ``__topic``, ``__probability`` and ``__kept``.

    ``targets`` may name shares per dimension; a dimension without one is
    flattened by its exponent.  ``topic`` is any column expression; the default
    is the text's form.  ``narrow`` leaves all columns but doc_id out and writes the
    others once, so that texts are read and counted once.
    """
    spark, flatten = docs.sparkSession, dict(FLATTEN, **(flatten or {}))
    words = n_words(F.col("text"))
    named = docs.withColumns({"__tokens": words, "__source": F.coalesce(F.col("source").cast("string"), F.lit("(none)")),
                              "__lang": F.coalesce(F.col("lang").cast("string"), F.lit("(none)"))})
    kind = topic if topic is not None else text_form(F.col("text"), F.col("__tokens"))
    named = named.withColumn("__topic", F.coalesce(kind.cast("string"), F.lit("(none)")))
    if narrow:
        named = stored(named.select("doc_id", "__tokens", "__source", "__lang", "__topic"), "tokens")
    cells = stored(named.where("__tokens > 0").groupBy(*[F.col(f"__{d}").alias(d) for d in DIMS])
                   .agg(F.sum("__tokens").alias("tokens")), "cells")
    wanted = {}
    for d in DIMS:
        t = (targets or {}).get(d)
        if t is None:
            t = flattened(cells, d, flatten[d])
        elif not isinstance(t, DataFrame):
            t = spark.createDataFrame([(str(k), float(v)) for k, v in t.items()], f"{d} string, target double")
        t = stored(t.join(cells.select(d).distinct(), d, "left_semi"), "target")
        wanted[d] = t.withColumn("target", F.col("target") / t.agg(F.sum("target").alias("s")).select("s").scalar())
    found = probabilities(rake(cells, wanted, rounds), rate, spread_rounds)
    found = found.select(*[F.col(d).alias(f"__c_{d}") for d in DIMS], F.col("weight").alias("__weight"),
                         F.col("probability").alias("__probability"))
    same = [F.col(f"__{d}") == F.col(f"__c_{d}") for d in DIMS]
    out = named.join(found, same[0] & same[1] & same[2], "left").drop(*[f"__c_{d}" for d in DIMS])
    out = out.withColumns({"__probability": F.coalesce("__probability", F.when(F.col("__tokens") == 0, 1.0), F.lit(0.0)),
                           "__weight": F.coalesce("__weight", F.lit(0.0))})
    return out.withColumn("__kept", draw(F.col("doc_id"), seed) < F.col("__probability"))


@beside
def mixed(docs: DataFrame, **options) -> DataFrame:
    """The sampled documents, with the columns of ``docs``."""
    return mix(docs, **options).where("__kept").select(*docs.columns)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mix(docs, narrow=True).select("doc_id", F.col("__source").alias("source"), F.col("__lang").alias("lang"),
                            F.col("__topic").alias("topic"), F.col("__tokens").alias("tokens"),
                            F.round("__weight", 9).alias("cell_weight"), F.round("__probability", 9).alias("probability"),
                            F.col("__kept").alias("kept"))


QUERIES = {"op4_mixing": op4_mixing}


def mix_ctes(docs: str) -> str:
    """CTEs up to ``mixed`` over the table or CTE ``docs``."""
    count = "length(text0) - length(translate(text0, '{}', ''))".format
    form = f"""CASE WHEN tokens = 0 THEN 'empty' WHEN ({count('|')}) * 5 > tokens THEN 'table'
      WHEN ({count('#*$%&<>')}) * 5 > tokens THEN 'symbols'
      WHEN (length(text0) - length(replace(text0, chr(10), '')) + 1) * 12 > tokens THEN 'short lines'
      WHEN tokens >= 1000 THEN 'long prose' ELSE 'prose' END"""
    # Each raking step divides by the sum over one dimension, nested in the order source, lang, topic.
    w = "weight"
    steps = []
    for d in DIMS:
        steps.append(f"SELECT * REPLACE (weight * t_{d} / sum({w}) OVER (PARTITION BY {d}) AS weight) FROM ")
    rounds = f"{steps[2]}({steps[1]}({steps[0]}raking WHERE k < {ROUNDS}))"
    ctes = f"""
m_words AS (SELECT *, coalesce(text, '') AS text0,
   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM {docs}),
m_named AS (SELECT * REPLACE (coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang),
   {form} AS topic FROM m_words),
m_cells AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM m_named WHERE tokens > 0 GROUP BY ALL),
"""
    for d in DIMS:
        ctes += (f"m_t_{d} AS (SELECT {d}, t / sum(t) OVER () AS t_{d} FROM "
                 f"(SELECT {d}, pow(sum(tokens), {FLATTEN[d]}) AS t FROM m_cells GROUP BY {d})),\n")
    ctes += f"""
raking AS (
  SELECT 0 AS k, source, lang, topic, tokens, tokens AS weight, t_source, t_lang, t_topic
  FROM m_cells JOIN m_t_source USING (source) JOIN m_t_lang USING (lang) JOIN m_t_topic USING (topic)
  UNION ALL
  SELECT * REPLACE (k + 1 AS k) FROM ({rounds})),
m_weights AS (SELECT source, lang, topic, tokens, weight / sum(weight) OVER () AS weight FROM raking WHERE k = {ROUNDS}),
spread AS (
  SELECT 0 AS k, *, least(1.0, weight * budget / tokens) AS p
  FROM (SELECT *, sum(tokens) OVER () * {RATE} AS budget FROM m_weights)
  UNION ALL
  SELECT k + 1, source, lang, topic, tokens, weight, budget,
    CASE WHEN p >= 1.0 THEN 1.0 ELSE least(1.0, coalesce(weight * (budget - taken) / nullif(open, 0) / tokens, 0)) END
  FROM (SELECT *, coalesce(sum(CASE WHEN p >= 1.0 THEN tokens END) OVER (), 0) AS taken,
               sum(CASE WHEN p < 1.0 THEN weight END) OVER () AS open FROM spread WHERE k < {SPREAD_ROUNDS})),
mixed AS (
  SELECT n.*, coalesce(s.weight, 0) AS m_weight,
    coalesce(s.p, CASE WHEN n.tokens = 0 THEN 1.0 ELSE 0.0 END) AS m_p,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::UBIGINT::DOUBLE / {float(16 ** 13)!r}
      < coalesce(s.p, CASE WHEN n.tokens = 0 THEN 1.0 ELSE 0.0 END) AS m_kept
  FROM m_named n LEFT JOIN (SELECT * FROM spread WHERE k = {SPREAD_ROUNDS}) s USING (source, lang, topic))
"""
    return ctes


ORACLE = {"op4_mixing": "WITH RECURSIVE " + mix_ctes("documents") + """
SELECT doc_id, source, lang, topic, tokens, round(m_weight, 9) AS cell_weight, round(m_p, 9) AS probability, m_kept AS kept
FROM mixed"""}
