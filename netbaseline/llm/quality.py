"""Quality rules: base counts, then a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed n-gram buckets are estimated: one from trusted
documents (good quality, not toxic, at most ``max_trusted`` of them), one from
the whole raw corpus.  The buckets grow with the square root of the corpus, as
the different n-grams of a text do, and the smoothing is a share of their mean
count, so that a verdict does not depend on the size of the corpus.  A document's score is the sum of log(trusted / raw)
over its n-grams divided by their number; it is kept if the score is not below
``threshold``.  N-grams: words, word pairs, and pairs of word shapes (runs of
upper case, lower case, digits and other characters, and whether both words
are the same), so that layout noise shows in words never seen before.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .bpe import sub_batches
from .common import WORD

BUCKETS_A_ROOT = 8         # buckets per square root of the corpus' bytes, rounded up to a power of two,
MAX_BITS = 24              # 2^24 at most: the ratios are broadcast (64 MB) from 4 TB of text on
MAX_TRUSTED = 100_000      # bound of the sample of labelled rows that the trusted model is fitted on
SMOOTHING = 1.0            # "no difference" in every bucket, in mean counts of a bucket
THRESHOLD = -0.25
MIN_WORDS = 50
MAX_KNOWN_WORDS = 150_000  # remembered hashes per worker

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
FEATURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "n_grams long, score double, base_failed boolean, kept boolean")

_words = re.compile(WORD)
_runs = re.compile(r"(.)\1+", re.S)
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


class _Shapes(dict):
    """Character -> class of characters, for str.translate."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        return self[code]


class WordHashes:
    """64-bit hashes of words and of their shapes, remembered up to a bound."""

    def __init__(self) -> None:
        self.codes: dict[str, int] = {}
        self.word = np.zeros(0, np.uint64)
        self.shape = np.zeros(0, np.uint64)
        self.classes = _Shapes()

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.codes) > MAX_KNOWN_WORDS:
            self.codes, self.word, self.shape = {}, self.word[:0], self.shape[:0]
            self.classes = _Shapes()
        new = list(set(words).difference(self.codes))
        self.codes.update(zip(new, range(len(self.codes), len(self.codes) + len(new))))
        digest = xxhash.xxh3_64_intdigest
        self.word = np.concatenate([self.word, np.fromiter(map(digest, new), np.uint64, len(new))])
        shapes = (digest(_runs.sub(r"\1", w.translate(self.classes))[:12]) for w in new)
        self.shape = np.concatenate([self.shape, np.fromiter(shapes, np.uint64, len(new))])
        at = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        return self.word[at], self.shape[at]


class Batch:
    """Words and n-gram buckets of several texts, in flat arrays."""

    def __init__(self, texts: list[str], hashes: WordHashes, bits: int):
        lists = [_words.findall(t) for t in texts]
        self.texts, self.lists, self.n = texts, lists, len(texts)
        self.doc = np.repeat(np.arange(self.n), [len(w) for w in lists])
        self.word, shape = hashes.of([w for words in lists for w in words])
        h, s, self.pair = self.word, shape, self.doc[1:] == self.doc[:-1]
        pairs = (h[1:] * _K[0] + (h[:-1] ^ _K[2]))[self.pair]
        shapes = ((s[1:] * _K[1] + (s[:-1] ^ _K[3])) + (h[1:] == h[:-1]) * _K[0])[self.pair]
        of = self.doc[1:][self.pair]
        self.gram_doc = np.concatenate([self.doc, of, of])
        g = np.concatenate([h, pairs, shapes ^ _K[2]])
        g = (g ^ (g >> np.uint64(31))) * _K[1]
        self.gram = (g >> np.uint64(64 - bits)).astype(np.int64)

    def repeat_words(self) -> np.ndarray:
        """Per text: words inside a three-word window that occurs twice or more in it."""
        covered = np.zeros(len(self.doc) + 2, bool)
        h, start = self.word, np.flatnonzero(self.doc[2:] == self.doc[:-2])
        if len(start):
            key = (h[start] * _K[0] ^ h[start + 1]) * _K[1] ^ h[start + 2]
            key = (key ^ (key >> np.uint64(29))) * _K[2] + self.doc[start].astype(np.uint64) * _K[3]
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            twice = start[order[np.r_[same, False] | np.r_[False, same]]]
            for k in range(3):
                covered[twice + k] = True
        return np.bincount(self.doc, covered[:len(self.doc)], minlength=self.n).astype(np.int64)


def _dup_lines(text: str) -> int:
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            n += line in seen
            seen.add(line)
    return n


def score_texts(texts: list[str], ratio: np.ndarray, hashes: WordHashes, threshold: float,
                min_words: int = MIN_WORDS) -> pd.DataFrame:
    """The columns of ``FEATURES`` for some texts; ``ratio``: log-likelihood ratio per bucket."""
    b = Batch(texts, hashes, len(ratio).bit_length() - 1)
    n_grams = np.bincount(b.gram_doc, minlength=b.n)
    total = np.bincount(b.gram_doc, ratio[b.gram], minlength=b.n)
    out = pd.DataFrame({
        "n_words": [len(w) for w in b.lists], "word_chars": [sum(map(len, w)) for w in b.lists],
        "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts], "n_dup_lines": [_dup_lines(t) for t in texts],
        "n_repeat_words": b.repeat_words(), "n_grams": n_grams, "score": total / np.maximum(n_grams, 1)})
    out["base_failed"] = (out["n_words"] < min_words) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
    out["kept"] = ~out["base_failed"] & (out["score"] >= threshold)
    return out


def bucket_bits(n_bytes: int) -> int:
    """Bits of a bucket's number for a corpus of ``n_bytes``."""
    return min(MAX_BITS, max(1, math.ceil(math.log2(BUCKETS_A_ROOT * math.sqrt(max(1, n_bytes))))))


def _count(bits: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, trusted, hashes = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64), WordHashes()
        for batch in batches:
            marks, at = batch["q_trusted"].to_numpy(bool), 0
            for texts in sub_batches(batch["q_text"]):
                b = Batch(texts, hashes, bits)
                raw += np.bincount(b.gram, minlength=1 << bits)
                trusted += np.bincount(b.gram[marks[at:at + b.n][b.gram_doc]], minlength=1 << bits)
                at += b.n
        seen = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": seen, "raw": raw[seen], "trusted": trusted[seen]})

    return count


def trusted_ids(labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """Ids of good, non-toxic labelled documents; the ``max_trusted`` with the smallest hash if there are more."""
    ids = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted).withColumnRenamed("doc_id", "t_id")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_trusted: int = MAX_TRUSTED, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log-likelihood ratio per bucket, counted over all documents.

    Every task reduces its rows to one row per bucket; the driver gets their
    sums (:func:`bucket_bits` bounds them).  The trusted ids, bounded by
    ``max_trusted``, are broadcast.  Without trusted documents all ratios are 0.
    """
    rows = docs.select(F.col(id_col).alias("q_id"), F.coalesce(F.col(text_col), F.lit("")).alias("q_text"))
    marked = (rows.join(F.broadcast(trusted_ids(labels, max_trusted)), F.col("q_id") == F.col("t_id"), "left")
              .select("q_text", F.col("t_id").isNotNull().alias("q_trusted")))
    bits = bucket_bits(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)
    sums = (marked.mapInPandas(_count(bits), "bucket long, raw long, trusted long").groupBy("bucket")
            .agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).toPandas())
    raw, trusted = np.zeros(1 << bits), np.zeros(1 << bits)
    raw[sums["bucket"]], trusted[sums["bucket"]] = sums["raw"], sums["trusted"]
    if not trusted.sum():
        return np.zeros(1 << bits)
    share, prior = trusted.sum() / raw.sum(), smoothing * raw.mean()
    return np.log((trusted + prior * share) / ((raw + prior) * share))


def quality_column(spark: SparkSession, text: Column, ratio: np.ndarray, threshold: float = THRESHOLD) -> Column:
    """Struct of ``FEATURES`` for a text (null: no words)."""
    shared = spark.sparkContext.broadcast(ratio.astype(np.float32))

    @F.pandas_udf(FEATURES)
    def rules(texts: pd.Series) -> pd.DataFrame:
        ratio, hashes = shared.value, _worker_hashes()
        parts = [score_texts(batch, ratio, hashes, threshold) for batch in sub_batches(texts)]
        return pd.concat(parts, ignore_index=True) if parts else score_texts([], ratio, hashes, threshold)

    return rules(text)


_hashes: list[WordHashes] = []


def _worker_hashes() -> WordHashes:
    if not _hashes:
        _hashes.append(WordHashes())
    return _hashes[0]


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_grams, score, base_failed, kept)``.

    One row per input row, whatever its id; null and empty texts have no words
    and fail the base rules.  Extra columns are ignored.
    """
    ratio = fit(docs, labels, id_col, text_col)
    rated = docs.select(F.col(id_col), quality_column(docs.sparkSession, F.col(text_col), ratio, threshold).alias("q_rules"))
    return rated.select(id_col, "q_rules.*")


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""
    ratio = fit(docs, labels, id_col, text_col)
    rated = docs.select(F.struct(*docs.columns).alias("row"),
                        quality_column(docs.sparkSession, F.col(text_col), ratio, threshold).alias("q_rules"))
    return rated.where("q_rules.kept").select("row.*")
