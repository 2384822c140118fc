import math
import random
import re
from collections import Counter

import cases
import duckdb
import numpy as np
from corpusflow.llm import ranked_search as search
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
PATTERN = re.compile(search.TERM)


def terms(text):
    return PATTERN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    found = [(doc, Counter(terms(text))) for doc, text in docs]
    found = [(doc, c) for doc, c in found if c]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = {}
    for item, text in items:
        if terms(text):
            asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        scored = []
        for doc, c in found:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, (doc is not None, doc or 0), doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "The river, the STONE and light!"), (2, None), (3, ""), (4, "unseen terms only"), (5, "garden"), (None, "letter music"),
         (6, "one"), (7, "Übung übung ÜBUNG naïve"), (8, "paper green"), (8, "table WINDOW")]
MORE = [(300, "Übung macht den Meister, naïve übung"), (301, "ÜBUNG"), (302, "a_b-c 日本語 42"), (303, "garden"), (304, "Garden!"), (305, "gardens")]


def tables(spark):
    docs = cases.documents(spark, [*cases.rows(), *[(d, t, "en", "a", 0) for d, t in MORE]], clashing=True)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit("x") for c in ("term", "terms", "block", "n", "doc_id", "score")})
    return docs, items


def test_brute_force_with_awkward_rows(spark):
    docs, items = tables(spark)
    plain = [(r[0], r[1]) for r in cases.rows()] + MORE
    for postings in (search.SHARD_POSTINGS, 40):  # one shard a task, and many
        got = search.ranked(docs.repartition(5), items, shard_postings=postings).collect()
        assert sorted(map(tuple, got), key=str) == brute(plain, ITEMS)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_TERMS", 4)
    docs, items = tables(spark)
    assert sorted(map(tuple, search.ranked(docs, items, k=3).collect()), key=str) == brute([(r[0], r[1]) for r in cases.rows()] + MORE, ITEMS, 3)


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert search.ranked(cases.empty(spark), items).count() == 0
    assert search.ranked(docs, items.limit(0)).count() == 0


def test_nra_against_full_sums_and_stops_early():
    rng = random.Random(5)
    for trial in range(40):
        n, t = rng.randint(1, 400), rng.randint(0, 6)
        lists = []
        for _ in range(t):
            docs = np.array(rng.sample(range(n), rng.randint(1, n)))
            impact = np.sort(np.array([rng.choice([1, 2, 3, 50, 100]) for _ in docs]))[::-1]  # many ties
            lists.append((docs, impact))
        ids = np.array(rng.sample(range(10_000), n))
        total = np.zeros(n)
        for d, x in lists:
            total[d] += x
        want = sorted((-s, i) for s, i in zip(total, ids) if s > 0)[:10]
        found, scores, _ = search.nra(lists, ids, 10, first_run=4)
        assert [(-s, i) for s, i in zip(scores, ids[found])] == want
    # Twelve documents lead both lists; the rest of 100,000 entries need not be read.
    docs = np.arange(50_000)
    impact = np.where(docs < 12, 1_000 - docs, 1)
    found, _, entries = search.nra([(docs, impact), (docs, impact)], docs, 10)
    assert found.tolist() == list(range(10)) and entries <= 2 * 64


def test_oracle(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = sorted(con.execute(search.ORACLE["op11_ranked_search"]).fetchall())
    assert sorted(map(tuple, search.op11_ranked_search(spark, SF).collect())) == want
