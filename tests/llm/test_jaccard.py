import random

import cases
import numpy as np
import pytest
from corpusflow.llm.jaccard import Bands, first_of_each, near_copies
from corpusflow.llm.occurrence import linked


def lower(b):
    return b.lower()


def sets_of(rows, width):
    out = []
    for doc, text, *_ in rows:
        w = [lower(x) for x in cases.words(text)]
        out.append(set(zip(*[w[k:] for k in range(width)])) if len(w) >= width else ({tuple(w)} if w else set()))
    return out


def brute(rows, width, percent):
    sets = sets_of(rows, width)
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for k, (doc, *_) in enumerate(rows):
        if doc is not None:
            least[top(k)] = min(least.get(top(k), doc), doc)
    return sorted(((doc, len(sets[k]), least.get(top(k)) if sets[k] else doc) for k, (doc, *_) in enumerate(rows)), key=str)


@pytest.mark.parametrize("width,percent,unit", [(3, 90, 2_000_000), (5, 80, 300)])
def test_brute_force(spark, width, percent, unit):
    got = near_copies(cases.documents(spark, clashing=True), width, percent, unit).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(cases.rows(), width, percent)


def test_empty_and_first_of_each(spark):
    assert near_copies(cases.empty(spark)).count() == 0
    docs = cases.documents(spark)
    kept = first_of_each(docs, 3, 90)
    assert kept.columns == docs.columns
    want = {doc for doc, _, root in brute(cases.rows(), 3, 90) if doc == root}
    assert {r.doc_id for r in kept.collect()} == want


@pytest.mark.parametrize("percent", [80, 90, 95])
def test_linked_sets_share_an_anchor(percent):
    rng = np.random.default_rng(percent)
    bands = Bands(percent)
    for _ in range(400):
        a = np.unique(rng.integers(0, 1 << 62, int(rng.integers(1, 120))).astype(np.uint64))
        b = set(a.tolist())
        for _ in range(int(rng.integers(0, 1 + len(a) // 4))):
            if rng.random() < 0.5 and len(b) > 1:
                b.discard(next(iter(b)))
            else:
                b.add(int(rng.integers(0, 1 << 62)))
        b = np.array(sorted(b), dtype=np.uint64)
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(a) + len(b) - both):
            assert set(bands.anchors(a).tolist()) & set(bands.anchors(b).tolist())


def test_search_equals_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        base = [rng.sample(range(60), rng.randint(1, 25)) for _ in range(3)]
        sets = []
        for _ in range(rng.randint(1, 20)):
            s = set(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                s.add(rng.randrange(70)) if rng.random() < 0.5 or not s else s.discard(rng.choice(sorted(s)))
            sets.append(np.array(sorted(s), dtype=np.uint64))
        rows = [(k, " ".join(f"w{t}" for t in s)) for k, s in enumerate(sets)]
        want = {doc: root for doc, _, root in brute(rows, 1, 80)}
        assert linked(sets, 80).tolist() == [want[k] for k in range(len(sets))]
