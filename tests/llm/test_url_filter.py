import math
import random
from collections import Counter

import public_tokenizers
from corpusflow.llm import url_filter as urls
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "page_id long, url string, html string"
RAW = [None, "", "no scheme/en/x", "http://", "https://EXAMPLE.com/en/1", "https://www.example.com/en/1?x=/fr/", "http://a.www.example.com/en/",
       "http://example.com/de/1", "http://xexample.com/en/1", "http://b.net/es/1#t", "http://b.net/fr", "http://net/fr/9", "http://b.net?x://c.com/en/",
       "ftp://h.org#frag", "x://y://z.com/en/", "http://bücher.example.org/Straße/ß", "http://cheappillsonline.example.org/buy/2",
       "http://freecasinobets.example.org/", "http://therightpaper.example.org/news/1", "http://b.com\n.x/en/", "http://" + "longname" * 3_000 + ".org/" + "p/" * 5_000]


def table(spark, rows=None):
    rng = random.Random(2)
    if rows is None:
        rows = [(k, u, None) for k, u in enumerate(RAW)] + [(None, RAW[4], ""), (4, RAW[4], "x"), (4, RAW[4], "x")]
        clean = ["news-paper", "stone.light", "travel-winter", "bridge", "m.market"]
        bad = ["cheap-pills", "casino-win", "www.free-bets", "m.casino-online"]
        rows += [(100 + k, f"https://{rng.choice(bad if k % 5 == 0 else clean)}.example.org/{rng.choice(['en', 'de'])}/{k}", None) for k in range(400)]
    return rows, spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("host", "path", "rule", "verdict", "score", "words", "word", "found")})


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def ruled(host, path):
    fits = [(len(r), r, v) for v, r in RULES
            if ("." + host).endswith("." + r.split("/", 1)[0]) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


def test_brute_force_with_awkward_rows(spark):
    rows, pages = table(spark)
    got = {(r.page_id, r.host, r.path): r for r in urls.judged(pages, WORDS).collect()}
    assert urls.judged(pages, WORDS).count() == len(rows)
    # The whole model once more, in plain Python.
    words = urls.vocabulary(WORDS)
    words += sorted(urls.BLOCKED_WORDS - set(words))
    places = [parsed(u) for _, u, _ in rows]
    import re
    counts = Counter(w for h, p in places for w in re.split("[^a-z]+", f"{h}/{p}".lower()) if w in set(words))
    model = urls.Unigrams(words, counts)
    tokens = [model.tokens(h, p) for h, p in places]
    label = [any(t[2:].decode() in urls.BLOCKED_WORDS for t in own if t[2:].isascii()) for own in tokens]
    sums = [Counter(), Counter()]
    for own, bad in zip(tokens, label):
        sums[bad].update(map(urls.bucket, own))
    prior = math.log((sum(label) + 1) / (sum(bool(t) for t in tokens) - sum(label) + 1))
    for (page, _, _), (host, path), own in zip(rows, places, tokens):
        r = got[page, host, path]
        total = sums[0].total() + sums[1].total()
        share = [[(c[b] + 100 * (sums[0][b] + sums[1][b]) / total) / (c.total() + 100) for b in map(urls.bucket, own)] for c in sums]
        score = prior + sum(math.log(y / x) for x, y in zip(*share))
        rule, verdict = ruled(host, path)
        assert r.rule == rule
        assert r.verdict == (verdict or ("block" if own and score > 0 else "allow"))
        assert r.score == -math.inf if not own else abs(r.score - score) < 1e-6 * max(1, abs(score))


def test_concatenated_names(spark):
    _, pages = table(spark)
    got = {r.page_id: r for r in urls.judged(pages, WORDS).collect()}
    assert {"cheap", "pills", "online"} <= set(got[16].words) and got[16].verdict == "block"
    assert {"free", "casino", "bets"} <= set(got[17].words) and got[17].verdict == "block"
    assert {"right", "paper"} & set(got[18].words) and got[18].verdict == "allow"
    assert got[0].verdict == "allow" and got[0].host == "" and got[0].words == []


def test_split_is_the_best_of_all_splits():
    model = urls.Unigrams(["cheap", "pills", "the", "rap", "her", "chea", "a", "p"], {"cheap": 3, "pills": 2, "the": 9})

    def cost(parts):
        return sum(model.log.get(w, model.unknown(len(w))) for w in parts)

    def splits(s):
        yield [s] if s else []
        for k in range(1, len(s)):
            for rest in splits(s[k:]):
                yield [s[:k], *rest]

    for s in (b"cheappills", b"therapist", b"qqq", b"xcheapx", b"a"):
        assert math.isclose(cost(model.split(s)), max(map(cost, splits(s))))
    assert model.split(b"cheappills") == [b"cheap", b"pills"]


def test_seeded_hosts_of_the_pages(spark):
    got = urls.op13_url_filter(spark, SF)
    bad = F.col("host").rlike("casino|pills|adult|bets|spam|ads-")
    assert got.where(F.col("rule").isNull()).where(bad != (F.col("verdict") == "block")).count() == 0
    assert got.count() == spark.read.parquet(f"{SF}/pages.parquet").count()


def test_empty_table(spark):
    assert urls.judged(table(spark, [])[1], WORDS).count() == 0
