"""WARC bundles and embeddings."""
import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from corpusflow.llm import embedding_dedup, warc
from corpusflow.llm.common import new_folder, stored
from corpusflow.llm.flat_graph import FlatGraph

PAGES = "page_id long, url string, html string"


def pages():
    rng = random.Random(4)
    big = ["<p>" + "x" * rng.randint(1000, 5000) + "é</p>" for _ in range(6)]
    out = [(k, f"http://h/{k}\nInjected: yes", rng.choice(big)) for k in range(40)]
    return out + [(50, None, None), (51, "", ""), (52, "u", "short"), (53, "u", "short"), (54, "u", "y" * 1000), (55, "u", "y" * 1000),
                  (56, "u", "y" * 999), (57, "u", "y" * 999), (58, "u", "long\r\n\r\nWARC/1.1\r\n" * 60_000), (None, "u", big[0] + "!"), out[0]]


def test_round_trip_and_roles(spark):
    table = spark.createDataFrame(pages(), PAGES).selectExpr("*", "'x' AS digest", "1 AS refers_to", "'y' AS payload")
    folder = new_folder(spark, "warc-test")
    index = warc.write_bundles(table, folder, bundles=3, frame_bytes=4000, bundle_bytes=300)
    got = warc.read_bundles(spark, folder, index).collect()
    assert len(got) == len(pages())
    head = {}
    for page, _, html in pages():
        if len((html or "").encode()) >= 1000 and page is not None:
            head[html] = max(head.get(html, page), page)
    want = []
    for page, _, html in pages():
        body = (html or "").encode()
        refers = head.get(html) if page is not None and head.get(html) != page else None
        want.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if refers is not None else "response", refers))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    bodies = {p: (h or "").encode() for p, _, h in pages()}
    rows = index.collect()
    assert len({r.bundle for r in rows}) > 3 and len({(r.bundle, r.frame) for r in rows}) > 10
    for row in rows:
        one = warc.fetch(folder, row)
        assert one["page_id"] == row.page_id and (one["payload"] is None or bytes(one["payload"]) == bodies[row.page_id])


def test_a_plain_decompressor_reads_a_bundle(spark):
    import zstandard
    folder = new_folder(spark, "warc-test")
    index = warc.write_bundles(spark.createDataFrame(pages(), PAGES).limit(20), folder, bundles=1)
    fs, base = warc.file_system(folder)
    with fs.open_input_file(f"{base}/{index.first().bundle}") as f:
        data = f.read()
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    n, at = 0, 0
    while at < len(plain):
        _, _, at = warc.parse(plain, at)
        n += 1
    assert n == 20


def test_no_pages(spark):
    folder = new_folder(spark, "warc-test")
    index = warc.write_bundles(spark.createDataFrame([], PAGES), folder)
    assert warc.read_bundles(spark, folder, index).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int"


def vectors():
    rng = np.random.default_rng(8)
    out = []
    for k in range(30):
        base = rng.normal(size=16)
        for j in range(int(rng.integers(1, 12))):
            out.append((len(out), (base + rng.normal(size=16) * 0.06 * (j > 1)).tolist(), int(k % 3)))
    n = len(out)
    out += [(n + 1, None, 1), (n + 2, [], 1), (n + 3, [0.0] * 16, 1), (n + 4, [math.nan] + [1.0] * 15, 1), (n + 5, [None] + [1.0] * 15, 1),
            (n + 6, [math.inf] * 16, 1), (n + 7, out[0][1], None), (n + 8, [1.0, 0.0], 0), (n + 9, [2.0, 0.0], 0), out[5], (None, out[6][1], out[6][2])]
    return out


def brute(rows, least=0.98):
    def fine(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    x = [np.array(v, dtype=np.float32).astype(float) if fine(v, label) else None for _, v, label in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            if x[a] is not None and x[b] is not None and rows[a][2] == rows[b][2] and len(x[a]) == len(x[b]):
                if x[a] @ x[b] / math.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= least:
                    n[a] += 1
                    n[b] += 1
                    p, q = top(a), top(b)
                    root[max(p, q)] = min(p, q)
    first = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            first[top(k)] = min(first.get(top(k), i), i)
    return sorted(((i, n[k], first.get(top(k))) for k, (i, *_) in enumerate(rows)), key=str)


def test_near_vectors(spark):
    table = spark.createDataFrame(vectors(), VECTORS).selectExpr("*", "'x' AS h1", "'y' AS x", "1 AS size", "'z' AS near")
    for shard, home in ((2000, 600), (20, 30)):
        got = stored(embedding_dedup.near_vectors(table, shard=shard, home=home))
        want = brute(vectors())
        rows = sorted(map(tuple, got.collect()), key=str)
        assert sum(a == b for a, b in zip(rows, want)) >= 0.95 * len(want) and len(rows) == len(want)
        assert all(a[1] <= b[1] for a, b in zip(rows, want))  # nothing below the limit is linked
    assert embedding_dedup.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def clustered(seed: int, bases: int, each: int, width: int = 24, noise: float = 0.1) -> np.ndarray:
    """Unit vectors around ``bases`` directions; at this noise some pairs of a base link and others do not."""
    rng = np.random.default_rng(seed)
    x = np.repeat(rng.normal(size=(bases, width)), each, axis=0)
    x = x + rng.normal(size=x.shape) * noise * rng.random((len(x), 1))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("least", [0.98, 0.9])
def test_linked_vectors_share_a_cell(least):
    for seed, noise in ((1, 0.1), (2, 0.3), (3, 1.0)):
        x = clustered(seed, 60, 20, noise=noise)
        centres = embedding_dedup.centroids(x[::3], 40)
        cells = embedding_dedup.visited(x, centres, embedding_dedup.border_margin(least)).astype(int)
        met, linked = cells @ cells.T > 0, x @ x.T >= least
        assert linked.sum() > len(x) and met[linked].all()
        assert (cells.sum(axis=1) >= 1).all()


def test_the_worst_pair_meets():
    """Two vectors at the limit, the border of two centres halfway between them: either visits both cells."""
    half = math.acos(0.98) / 2
    x = np.array([[math.cos(half), math.sin(half)], [math.cos(half), -math.sin(half)]])
    centres = np.array([[math.cos(0.6), math.sin(0.6)], [math.cos(0.6), -math.sin(0.6)]])
    cells = embedding_dedup.visited(x, centres, embedding_dedup.border_margin(0.98))
    assert (cells[0] & cells[1]).any()


def test_a_cell_is_cut_where_it_saves_work():
    margin = embedding_dedup.border_margin(0.98)
    spread = clustered(4, 80, 20)
    assert len(embedding_dedup.cut(spread, 100_000, 600, 2_000, margin)) > 1
    tight = clustered(5, 1, 1600, noise=0.05)
    assert len(embedding_dedup.cut(tight, 100_000, 600, 2_000, margin)) == 0
    assert embedding_dedup.blocks_of([1, 2_000, 2_001, 10_000], 2_000).tolist() == [1, 1, 3, 10]


def test_the_graph_computes_less_than_all_pairs():
    """Both the growth and the search, pruning included; the links are those of the full product."""
    for x in (clustered(6, 400, 5, width=64), clustered(7, 25, 80, width=64)):
        graph = FlatGraph(x)
        graph.grow()
        found, true = graph.links(0.98), x @ x.T >= 0.98
        np.fill_diagonal(true, False)
        assert graph.computed < 0.7 * len(x) ** 2
        assert not (found & ~true).any() and found.sum() >= 0.98 * true.sum()
        lengths = (graph.edges >= 0).sum(axis=1)
        assert lengths.min() > 0


def test_the_graph_of_few_vectors():
    assert FlatGraph(np.zeros((0, 3))).grow().shape[0] == 0
    one = FlatGraph(np.array([[1.0, 0.0]]))
    assert (one.grow() == -1).all() and not one.links(0.98).any()
    same = FlatGraph(np.array([[1.0, 0.0]] * 40))
    same.grow()
    assert same.links(0.98).sum() == 40 * 39


def test_recall_over_hundreds_of_cells(spark):
    """A label of some hundred cells, cut twice: ids that 20 divides, against all rows."""
    x = clustered(9, 1500, 6, width=32)
    rows = [(k, v.tolist(), 1 if k // 6 % 10 else 2) for k, v in enumerate(x)]
    table = stored(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    rows, classes = embedding_dedup.classes_of(table, "vec_id", "embedding", "label")
    cells = stored(embedding_dedup.in_cells(stored(classes), 0.98, 120, 40))
    names = {c for r in cells.collect() for c in r.cells}
    assert len(names) > 200
    found = stored(embedding_dedup.near_vectors(table, shard=120, home=40))
    assert embedding_dedup.audit_recall(table, found, block=300) >= 0.95
    label = np.arange(len(x)) // 6 % 10 > 0
    true = sum(((x[k] @ x.T >= 0.98) & (label == label[k])).sum() - 1 for k in range(0, len(x), 20))
    assert true > 1000
    got = found.where("vec_id % 20 = 0").groupBy().sum("n_links").first()[0]
    assert 0.95 * true <= got <= true
    assert embedding_dedup.audit_recall(table, found.selectExpr("vec_id", "0L AS n_links")) == 0.0


def test_oracles(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    assert sorted(map(tuple, warc.op5_warc(spark, sf).collect())) == sorted(con.execute(warc.ORACLE["op5_warc"]).fetchall())
    found = embedding_dedup.op6_embedding_dedup(spark, sf)
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(embedding_dedup.ORACLE["op6_embedding_dedup"]).fetchall())
    assert embedding_dedup.audit_recall(spark.read.parquet(f"{sf}/embeddings.parquet"), found) >= 0.9
