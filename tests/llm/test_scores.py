"""Toxicity, language and compression rules."""
import base64
import math
import random
import re

import cases
from corpusflow.llm import compression, language, toxicity
from corpusflow.llm.kneser_ney import ClassModels, grams
from pyspark.sql import functions as F

INSULTS = ["blorgface", "snarkwit", "grubbling"]


def toxic_rows(n=400, seed=5):
    rng = random.Random(seed)
    out, labels = [], []
    for k in range(n):
        words = cases.prose(rng, rng.randint(20, 300)).split()
        bad = k % 4 == 0
        if bad:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + rng.choice(["", "s", "!"]))
        out.append((k, " ".join(words), "en", "a", 0))
        labels.append((k, 1, int(bad)))
    return out, labels


def test_toxicity_separates_held_out_documents(spark):
    rows, labels = toxic_rows()
    rows += [(900, None, None, None, None), (901, "", "en", "a", 0), (None, "a snarkwit", "en", "a", 0), (902, "*** ###", "en", "a", 0),
             (903, cases.prose(random.Random(1), 8000) + " you grubbling", "en", "a", 0), rows[0]]
    table = spark.createDataFrame([*labels, (900, 1, None), (None, 1, 1), (0, 1, 1)], "doc_id long, quality int, toxic int")
    docs = cases.documents(spark, rows, clashing=True)
    got = toxicity.scored(docs, toxicity.fit(docs, table)).collect()
    truth = {k: t for k, _, t in labels}
    known = [(r["__score"] >= 0.7) == bool(truth[r.doc_id]) for r in got if r.doc_id in truth]
    assert sum(known) / len(known) > 0.97
    by_id = {r.doc_id: r["__score"] for r in got}
    assert all(0 <= s <= 1 for s in by_id.values()) and by_id[900] == by_id[901] == by_id[902] < 0.5 and by_id[903] >= 0.7
    kept = toxicity.without_toxic(docs, table)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = cases.documents(spark)
    assert {r["__score"] for r in toxicity.scored(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    assert toxicity.scored(cases.empty(spark), toxicity.fit(cases.empty(spark), none)).count() == 0


def test_toxicity_models_hold_every_gram_of_the_sample(spark):
    rng = random.Random(8)
    rows = [(k, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(120)), "en", "a", 0) for k in range(700)]
    docs = cases.documents(spark, rows)
    table = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k, *_ in rows], "doc_id long, quality int, toxic int")
    learnt = docs.where(~toxicity.held_out(F.col("doc_id")) & (F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(4)) != 0)).select("text")
    found = {g for r in learnt.collect() for w in r.text.split() for g in grams(w)}
    models = toxicity.fit(docs, table).models
    assert len(found) > 200_000 and found == {g for g in models.seen if len(g) == models.order}


def test_kneser_ney_sums_to_one():
    counts = {}
    for word, row in (("abab", (3, 1)), ("abba", (0, 4)), ("baa", (2, 2))):
        for g in grams(word, 3):
            old = counts.get(g, (0, 0))
            counts[g] = (old[0] + row[0], old[1] + row[1])
    models = ClassModels(counts, order=3, shared=1)
    letters = {g[-1] for g in counts}
    for h in {g[:-1] for g in counts}:
        for c in (0, 1):
            total = sum(models.probability(h + x)[c] for x in letters)
            assert 0.7 < total <= 1 + 1e-9  # what is left is for characters never seen
    assert math.isfinite(models.log_ratio("zzz")) and models.log_ratio("abab") > models.log_ratio("abba")


def test_language_on_held_out_documents(spark):
    rng = random.Random(2)
    lexicon = {"en": cases.WORDS, "de": "der und die nicht straße über können fenster garten brücke winter zeit schön grün".split(),
               "ru": "и не на река камень свет бумага окно сад письмо музыка число зима мост".split()}
    rows = [(k, " ".join(rng.choice(lexicon[lang]) for _ in range(rng.randint(3, 80))), lang, "a", 0)
            for k in range(300) for lang in [rng.choice(sorted(lexicon))]]
    extra = [(900, None, "en", "a", None), (901, "", "en", "a", 0), (902, "123 !!! --", "en", "a", 0), (903, "straße über die brücke " * 5000, None, "a", 0),
             (None, "река и мост", "ru", "a", 0), rows[0]]
    docs = cases.documents(spark, rows + extra, clashing=True)
    got = {r.doc_id: r for r in language.identified(docs, language.fit(docs)).collect()}
    truth = {k: lang for k, _, lang, *_ in rows}
    assert sum(got[k].lang_pred == v for k, v in truth.items()) / len(truth) > 0.98
    assert [got[k].lang_pred for k in (900, 901, 902, 903, None)] == ["und", "und", "und", "de", "ru"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.identified(cases.empty(spark), language.fit(cases.empty(spark))).count() == 0
    unknown = docs.where("lang IS NULL")
    assert {r.lang_pred for r in language.identified(unknown, language.fit(unknown)).collect()} == {"und"}


def base_brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k:k + 8]), []).append(k)
    inside = {j for at in windows.values() if len(at) > 1 for k in at for j in range(k, k + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
            n < 20 or 100 * len(inside) > 30 * n)


def test_compression_base_columns_and_bands(spark):
    rng = random.Random(9)
    noise = " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(rng.randint(3, 9))) for _ in range(900))
    rows = cases.rows() + [(300, "a b c d e f g h i\n" * 40, "en", "a", 0), (301, "ça | très #   x\n" * 3, "fr", "a", 0),
                           (302, noise, "en", "a", 0), (303, "buy now " + "cheap pills today " * 400, "en", "a", 0), (304, "x y " * 7 + "z " * 9, "en", "a", 0)]
    got = compression.compression_rules(cases.documents(spark, rows, clashing=True)).collect()
    assert len(got) == len(rows)
    for r, (doc, text, *_) in zip(sorted(got, key=lambda r: (str(r.doc_id), r.n_words)), sorted(rows, key=lambda r: (str(r[0]), len(cases.words(r[1]))))):
        assert (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (doc, *base_brute(text))
        assert r.kept is False or not r.base_failed
    by_id = {r.doc_id: r for r in got}
    assert by_id[302].reason == "incompressible" and not by_id[303].kept and not by_id[201].kept
    assert compression.compression_rules(cases.empty(spark)).count() == 0


def test_compression_chunks_cover_the_whole_text():
    import zstandard
    for n in (0, 4095, 4096, 4097, 8191, 8192, 8193, 20_000):
        data = random.Random(n).randbytes(n)
        chunks = compression.chunked(data)
        assert all(len(c) == 4096 for c in chunks) and len(chunks) == (-(-n // 4096) if n >= 4096 else 0)
        assert not chunks or data == b"".join(chunks[:-1])[:n - 4096] + chunks[-1]
    rng, compressor = random.Random(4), zstandard.ZstdCompressor(level=compression.LEVEL)
    lexicon = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(400)]
    clean = " ".join(rng.choices(lexicon, k=4000))
    for size, chunks in ((4096, 1), (8192, 2), (9000, 3)):
        assert compression.judge(clean[:size], compressor)[6:11:2] == (True, chunks, None)
    encoded = base64.b64encode(rng.randbytes(4090))[:4090].decode()
    for size in (3990, 8192):
        assert compression.judge(clean[:size] + encoded, compressor)[6] is False
    assert compression.judge(clean[:8192] + encoded, compressor)[8:] == (3, 1, "chunks")
