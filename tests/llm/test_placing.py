"""Mixing, sharding and packing."""
import random
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import cases
import duckdb
import pytest
from corpusflow.llm import mixing, packing, sharding
from pyspark.sql import functions as F


def test_mixing_meets_its_marginals(spark):
    cells = [(s, lang, t, tokens) for s, lang, t, tokens in
             [("a", "en", "x", 900), ("a", "de", "x", 50), ("b", "en", "x", 20), ("b", "de", "y", 30), ("a", "en", "y", 10), ("b", "en", "y", 5), ("a", "de", "y", 7), ("b", "de", "x", 9)]]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.4, "b": 0.6}, "lang": {"en": 0.7, "de": 0.3}, "topic": {"x": 0.5, "y": 0.5}}
    tables = {d: spark.createDataFrame(list(v.items()), f"{d} string, target double") for d, v in targets.items()}
    raked = mixing.rake(df, tables, rounds=30)
    for d, shares in targets.items():
        got = {r[d]: r.w for r in raked.groupBy(d).agg(F.sum("weight").alias("w")).collect()}
        assert got == pytest.approx(shares, abs=1e-4)
    found = mixing.probabilities(raked, rate=0.3, spread_rounds=6).collect()
    assert all(0 <= r.probability <= 1 for r in found)
    assert sum(r.probability * r.tokens for r in found) <= 0.3 * sum(c[3] for c in cells) + 1e-6


def test_mixing_awkward_rows(spark):
    docs = cases.documents(spark, clashing=True)
    got = mixing.mix(docs).collect()
    assert len(got) == len(cases.rows())
    for r in got:
        assert r["__tokens"] == len(cases.words(r.text)) and 0 <= r["__probability"] <= 1
        assert r["__kept"] or r["__tokens"] > 0
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mix(cases.empty(spark)).count() == 0
    assert mixing.mix(docs, targets={"lang": {"en": 1.0}}).where("__kept AND __lang = 'de' AND __tokens > 0").count() == 0


def test_sharding_laws(spark):
    rows = cases.rows() * 3
    docs = cases.documents(spark, [(None if r[0] is None else r[0] + 1000 * (k % 3), *r[1:]) for k, r in enumerate(rows)], clashing=True)
    got = sharding.shard(docs, shards=5).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    homes, loads, slots, groups = defaultdict(set), Counter(), defaultdict(list), Counter()
    for r in got:
        if r.doc_id is not None:
            body = (text[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(body) + 16, zlib.crc32(body))
        homes[r.text_crc32].add(r.shard)
        groups[r.text_crc32] += r.size
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) <= sum(loads.values()) / 5 + max(groups.values())
    assert sharding.shard(cases.empty(spark)).count() == 0


def test_schedule_equals_single_steps():
    rng = random.Random(5)
    for _ in range(60):
        shards = rng.randint(1, 9)
        bins = [(size, n, size * n) for size in rng.sample(range(1, 60), rng.randint(1, 12)) for n in [rng.choice([1, 2, 7, 40, 333])]]
        loads, want = [0] * shards, []
        for size, n, _ in sorted(bins, reverse=True):
            got = [0] * shards
            for _ in range(n):
                s = min(range(shards), key=lambda k: (loads[k], k))
                loads[s] += size
                got[s] += 1
            want.append((size, list(accumulate(got))))
        assert sharding.schedule(bins, shards) == want
    assert sharding.schedule([(5, 10**12, 5 * 10**12)], 3) == [(5, [333333333334, 666666666667, 10**12])]


def test_schedule_is_longest_processing_time():
    bins = [(5, 3, 15), (4, 2, 8), (1, 7, 7)]
    plan = dict(sharding.schedule(bins, 2))
    loads = [0, 0]
    for key, ends in plan.items():
        n = [ends[0], ends[1] - ends[0]]
        each = {5: 5, 4: 4, 1: 1}[key]
        loads = [a + each * b for a, b in zip(loads, n)]
        assert ends[-1] == {5: 3, 4: 2, 1: 7}[key]
    assert loads == [15, 15]
    big = [(k, 1_000_003, 1_000_003 * k) for k in range(1, 50)]
    loads = Counter()
    for key, ends in sharding.schedule(big, 7):
        for s, (a, b) in enumerate(zip([0, *ends], ends)):
            loads[s] += (b - a) * key
    assert max(loads.values()) - min(loads.values()) <= 2


def test_packing_round_trip(spark):
    import numpy as np
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    docs = cases.documents(spark, clashing=True)
    got = packing.packed(docs, capacity=64, with_ids=True).collect()
    sequences = defaultdict(list)
    for r in got:
        assert len(r.ids) == r.length <= 64 and zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 64
    want = Counter(tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for _, t, *_ in cases.rows())
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    whole = Counter()
    for rows in by_doc.values():
        lone = {(r.start, tuple(r.ids), r.doc_tokens) for r in rows}
        if len({s for s, *_ in lone}) == len(lone):
            times = len(rows) // len(lone)
            ids = tuple(t for _, part, _ in sorted(lone) for t in part)
            assert len(ids) == rows[0].doc_tokens
            whole[ids] += times
    assert not whole - want and sum(whole.values()) >= len(cases.rows()) - 2
    filled = sum(r.length for r in got)
    assert len(sequences) <= 1.05 * filled / 64 + 1
    assert packing.packed(cases.empty(spark)).count() == 0


def test_word_table_equals_tokenizer():
    from corpusflow.llm.word_ids import WordIds
    from tokenizers import Tokenizer
    path = packing.default_vocabulary()
    table, tokenizer = WordIds(path), Tokenizer.from_file(path)
    texts = ["it's DON'T <|endoftext|> <|EndOfText|>x 12ab,, ÉCOLE é. Σίσυφος İx ﬁn µ ª º. ǅ", "", "áb ć. 'S ' 're. ..,", "x y z\x85q \x1cw",
             "日本語 текст ТЕКСТ. ß. ÿ! À?", " \n", "a.b. c!? ...end", *[t or "" for _, t, *_ in cases.rows()]]
    flat, ends = table.encode_texts(texts)
    for t, a, b in zip(texts, [0, *ends], ends):
        assert flat[a:b].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_plan_places_the_whole_histogram():
    histogram = {2048: 10, 1500: 7, 600: 9, 548: 7, 100: 31, 7: 100_000, 1: 5}
    patterns = packing.plan(histogram, 2048)
    placed = Counter()
    for count, lengths in patterns:
        assert sum(lengths) <= 2048
        for length in lengths:
            placed[length] += count
    assert placed == histogram
    spots = packing.places(patterns)
    for length, rows in spots.items():
        assert rows[-1][0] == histogram[length] and [r[0] for r in rows] == sorted({r[0] for r in rows})


def test_mixing_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute("SELECT doc_id, topic, tokens, probability, kept FROM (" + mixing.ORACLE["op4_mixing"] + ")").fetchall()
    got = mixing.op4_mixing(spark, sf).select("doc_id", "topic", "tokens", "probability", "kept").collect()
    assert sorted(map(tuple, got)) == [(a, b, c, pytest.approx(d, abs=1e-8), e) for a, b, c, d, e in sorted(want)]
