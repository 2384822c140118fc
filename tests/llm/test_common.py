"""Helpers shared by the operators."""
import itertools

import pytest
from corpusflow.llm.common import block_pairs, numbered, stored
from corpusflow.llm.components import components
from pyspark.sql import functions as F


def test_components_of_a_chain_a_hub_and_loops(spark):
    chain = [(k + 1, k) for k in range(100, 130)]
    hub = [(500, k) for k in range(501, 560)] + [(501, 500), (500, 501)]
    edges = chain + hub + [(-5, -4), (9, 9)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    want = {**{k: 100 for k in range(100, 131)}, **{k: 500 for k in range(500, 560)}, -5: -5, -4: -5}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_say_when_rounds_run_out(spark):
    with pytest.raises(RuntimeError):
        components(spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long"), max_rounds=1)


def test_numbers_are_gapless_in_each_group(spark):
    rows = [("hot", k) for k in range(300)] + [("one", 1), (None, 2), (None, 3)]
    table = stored(spark.createDataFrame(rows, "g string, k long"))
    got = {}
    for r in numbered(table, ["g"], ["k"], "at", parts=7).collect():
        got.setdefault(r.g, []).append(r.at)
    assert {g: sorted(at) for g, at in got.items()} == {"hot": list(range(300)), "one": [0], None: [0, 1]}


def test_every_two_rows_meet_in_a_pair_of_blocks(spark):
    for blocks in (1, 2, 5):
        rows = spark.range(blocks).select(F.col("id").cast("int").alias("own"), F.lit(blocks).alias("blocks"))
        pairs = {r.own: {(p.i, p.j) for p in r.p} for r in rows.select("own", block_pairs().alias("p")).collect()}
        for a, b in itertools.combinations_with_replacement(range(blocks), 2):
            assert pairs[a] & pairs[b]
        assert max(map(len, pairs.values())) == max(1, blocks - 1)
