"""URL filters: host word segmentation and naive Bayes, under explicit rules.

1. Host and path are cut out of the url by column expressions.
2. A rule fits its host and all subdomains if the path starts with the rule's;
   of the fitting rules the longest decides.
3. Unigram model: half of a word's probability is its share of the words that
   stand between separators in all urls, half falls with its rank in a public
   vocabulary.  Only words of that list are counted, so what the driver gets is
   bounded by the list.  Viterbi splits every run of letters into the words of
   the highest probability (``cheappills`` -> cheap pills); letters in no list
   form pieces of up to ``LONGEST_WORD`` at a cost per piece and letter.
4. Multinomial naive Bayes over the words of host and path (``h:`` and ``p:``),
   hashed into ``2 ** BITS`` counters, so the model is bounded, whatever the urls
   hold.  It is trained on all urls: one with a word of ``BLOCKED_WORDS`` counts
   as block, others as allow; words that keep such company get their weight
   from that.  Counts are summed in every task before they are shuffled.
5. A url with no rule is blocked if its log odds are above 0.

Defined cases: a null url or one without ``://`` has an empty host and path, no
words and no rule, and is allowed; a url without a path has an empty one, which
no rule fits that has a path; repeated rows get the same verdict; very long urls
are read whole; an empty table gives an empty result; columns other than page_id
and url are not read.
"""
from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import read, ship_package

BITS, SHARED, LONGEST_WORD, MAX_CHUNKS = 18, 100.0, 20, 50_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST, PATH = r"(?s)^.*?://([^/?#]*)", r"(?s)^.*?://[^/?#]*([^?#]*)"
#: Seed words: a url that holds one of them (as a word of its own after segmentation) is a training example of class block.
BLOCKED_WORDS = frozenset("""
adult ads adserver adware backlinks banner bet bets betting bingo bitcoins blackjack botnet bondage brothel camgirls casino casinos
cialis clickbait clickfarm counterfeit cracks crackz dating doorway drugs erotic escort escorts fetish gambling hacked
hentai hookup hookups jackpot keygen lottery lotto malware milf nude nudes payday phishing pharmacy pills pirated poker porn porno
porntube replica roulette scam sex sexy slots spam spammer spyware sportsbook steroids strip swingers torrent torrents tracker
trojan viagra virus warez webcams wagering xxx
""".split())
_CHUNK = re.compile(rb"[a-z]+|[0-9]+|[\x80-\xff]+")


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """(rule, verdict) of the longest fitting rule, or null. The rules are a parameter, written out as one expression."""
    kind = "struct<rule:string,verdict:string>"
    out = F.lit(None).cast(kind)
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def vocabulary(path: str) -> list[str]:
    """The lower-case words of a public vocabulary with word ends, most frequent first; single letters last."""
    with open(path, encoding="utf-8") as f:
        known = json.load(f)["model"]["vocab"]
    words = [t[:-4] for t in sorted(known, key=known.get) if t.endswith("</w>") and re.fullmatch("[a-z]{1,20}", t[:-4])]
    return [w for w in words if len(w) > 1] + [w for w in words if len(w) == 1]


class Unigrams:
    """Word probabilities and the best split of a run of letters."""

    def __init__(self, words: list[str], counts: dict[str, int]):
        """``words`` by falling frequency; ``counts`` of some of them in the corpus."""
        weights = [1 / (rank + 10) for rank in range(len(words))]
        scale, total = 0.5 / max(1e-9, sum(weights)), max(1, sum(counts.values()))
        self.log = {w.encode(): math.log(x * scale + 0.5 * counts.get(w, 0) / total) for w, x in zip(words, weights)}
        self.cut: dict[bytes, list[bytes]] = {}

    def unknown(self, length: int) -> float:
        """Far below a listed word, and about one letter in 27 for each letter."""
        return -20.0 - 3.3 * length

    def split(self, letters: bytes) -> list[bytes]:
        """The words of the highest product of probabilities; of equal ones the one with the earliest last cut."""
        best, start = [0.0], [0]
        for end in range(1, len(letters) + 1):
            top, at = -math.inf, 0
            for begin in range(max(0, end - LONGEST_WORD), end):
                piece = letters[begin:end]
                value = best[begin] + (self.log[piece] if piece in self.log else self.unknown(len(piece)))
                if value > top:
                    top, at = value, begin
            best.append(top)
            start.append(at)
        out, end = [], len(letters)
        while end:
            out.append(letters[start[end]:end])
            end = start[end]
        return out[::-1]

    def words(self, text: bytes) -> list[bytes]:
        out = []
        for chunk in _CHUNK.findall(text):
            if 97 <= chunk[0] <= 122:
                if chunk not in self.cut:
                    if len(self.cut) >= MAX_CHUNKS:
                        self.cut.clear()
                    self.cut[chunk] = self.split(chunk)
                out += self.cut[chunk]
            else:
                out.append(b"0" if chunk[0] < 128 else chunk)
        return out

    def tokens(self, host: str, path: str) -> list[bytes]:
        return [b"h:" + w for w in self.words(host.encode().lower())] + [b"p:" + w for w in self.words(path.encode().lower())]


def bucket(token: bytes, bits: int = BITS) -> int:
    return zlib.crc32(token) & ((1 << bits) - 1)


def is_seed(tokens: list[bytes], seeds: frozenset[bytes]) -> bool:
    return any(t[2:] in seeds for t in tokens)


def fit_unigrams(urls: DataFrame, words: list[str]) -> Unigrams:
    """Counts of the listed words in all hosts and paths of ``urls`` (host, path)."""
    spark = urls.sparkSession
    listed = F.broadcast(spark.createDataFrame([(w,) for w in words], "listed string"))  # the list's size bounds it
    parts = F.split(F.lower(F.concat_ws("/", "host", "path")), "[^a-z]+")
    each = urls.select(F.explode(parts).alias("word")).join(listed, F.col("word") == F.col("listed"))
    return Unigrams(words, {r.word: r["count"] for r in each.groupBy("word").count().collect()})


class NaiveBayes:
    def __init__(self, counts: np.ndarray, urls: np.ndarray, shared: float = SHARED):
        """``counts``: (allow, block) x bucket; ``urls``: examples of the two classes.

        A class is smoothed by ``shared`` words drawn like those of both classes, so a
        word that neither has seen says nothing, however unequal the classes are.
        """
        held = counts.sum(0) > 0
        both = counts.sum(0) / max(1, counts.sum())
        log = np.log((counts + shared * both)[:, held]) - np.log(counts.sum(1, keepdims=True) + shared)
        self.ratio = np.zeros(counts.shape[1])
        self.ratio[held] = log[1] - log[0]
        self.prior = math.log((urls[1] + 1) / (urls[0] + 1))

    def score(self, tokens: list[bytes]) -> float:
        """Log odds of class block; without tokens the url is allowed."""
        return float(self.prior + sum(self.ratio[bucket(t)] for t in tokens)) if tokens else -math.inf


def fit_bayes(urls: DataFrame, model: Unigrams, seeds: frozenset[str] = BLOCKED_WORDS) -> NaiveBayes:
    """Token counts of all urls (host, path) by class, at most ``2 ** (BITS + 1)`` of them."""
    ship_package(urls.sparkSession)
    shared = urls.sparkSession.sparkContext.broadcast((model, frozenset(s.encode() for s in seeds)))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigrams, bad = shared.value
        counts, examples = np.zeros((2, 1 << BITS), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in found:
            for host, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = unigrams.tokens(host, path)
                label = int(is_seed(tokens, bad))
                examples[label] += bool(tokens)
                for t in tokens:
                    counts[label, bucket(t)] += 1
        for label in (0, 1):
            at = np.flatnonzero(counts[label])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at) + 1, label, np.int32)), pa.array(np.append(at, -1).astype(np.int32)),
                                              pa.array(np.append(counts[label, at], examples[label]))], names=["label", "bucket", "n"])

    sums = urls.select("host", "path").mapInArrow(run, "label int, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    counts, examples = np.zeros((2, 1 << BITS)), np.zeros(2)
    for r in sums.collect():
        if r.bucket < 0:
            examples[r.label] = r.n
        else:
            counts[r.label, r.bucket] = r.n
    return NaiveBayes(counts, examples)


def judged(pages: DataFrame, vocabulary_path: str, rules: tuple[Rule, ...] = RULES,
           seeds: frozenset[str] = BLOCKED_WORDS) -> DataFrame:
    """page_id, host, path, rule, verdict, score (log odds of block) and words of every row of ``pages`` (page_id, url)."""
    spark = pages.sparkSession
    ship_package(spark)
    kind = pages.schema["page_id"].dataType.simpleString()
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    listed = vocabulary(vocabulary_path)
    listed += sorted(seeds - set(listed))
    unigrams = fit_unigrams(urls, listed)
    shared = spark.sparkContext.broadcast((unigrams, fit_bayes(urls, unigrams, seeds)))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, bayes = shared.value
        for batch in found:
            tokens = [model.tokens(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            words = [[t[2:].decode("utf-8", "replace") for t in own] for own in tokens]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([bayes.score(t) for t in tokens], pa.float64()), pa.array(words, pa.list_(pa.string()))],
                                             names=["page_id", "host", "path", "score", "words"])

    scored = urls.mapInArrow(run, f"page_id {kind}, host string, path string, score double, words array<string>")
    scored = scored.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", own).alias("verdict"), "score", "words")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return judged(read(spark, sf_dir, "pages"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op13_url_filter": op13_url_filter}
