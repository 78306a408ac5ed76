import re
from collections import Counter

import numpy as np
import pytest

from netbaseline.llm import quality as Q, queries

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORDS.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))


def test_base_counts(spark):
    texts = ["", None, "a b c a b c", "one\none\n \none", "a b a b a b a b", "#x $y\u3000z|\x1c<>", "\u00e9 \u00e8\xa0\u00e9",
             "w " * 5000, "l1\nl2\nl1\nl1", "a b"]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)] + [(None, "a", 1.0), (3, "b", 1.0), (3, "b", 1.0)],
                               "doc_id long, text string, score double")
    out = Q.quality_rules(df, labels).collect()
    assert len(out) == len(texts) + 3
    for r in out:
        if r["doc_id"] is not None and not (r["doc_id"] == 3 and r["n_words"] == 1):
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            assert tuple(r[c] for c in names) == base(texts[r["doc_id"]])
            assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
    assert Q.quality_rules(df.where("false"), labels).collect() == []
    assert Q.keep_quality(df, labels).columns == df.columns


def grams(text):
    """Words, word pairs and pairs of word shapes of a text, as tuples."""
    words = WORDS.findall(text or "")
    kind = lambda c: "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
    shape = lambda w: re.sub(r"(.)\1+", r"\1", "".join(map(kind, w)), flags=re.S)[:12]
    out = [("w", w) for w in words] + [("p", a, b) for a, b in zip(words, words[1:])]
    return out + [("s", shape(a), shape(b), a == b) for a, b in zip(words, words[1:])]


def test_scores_equal_counts_of_the_ngrams_themselves(spark, monkeypatch):
    """With far more buckets than n-grams the scores are those of a model over the n-grams."""
    monkeypatch.setattr(Q, "bucket_bits", lambda n: 24)
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.where("doc_id < 60")
    rows = docs.select("doc_id", "text").collect()
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and not r["toxic"]}
    raw, trusted = Counter(), Counter()
    for r in rows:
        found = grams(r["text"])
        raw.update(found)
        trusted.update(found if r["doc_id"] in good else ())
    share, prior = sum(trusted.values()) / sum(raw.values()), Q.SMOOTHING * sum(raw.values()) / (1 << 24)
    ratio = {g: np.log((trusted[g] + prior * share) / ((n + prior) * share)) for g, n in raw.items()}
    got = {r["doc_id"]: (r["n_grams"], r["score"]) for r in Q.quality_rules(docs, labels).collect()}
    for r in rows:
        found = grams(r["text"])
        assert got[r["doc_id"]][0] == len(found)
        assert abs(got[r["doc_id"]][1] - sum(ratio[g] for g in found) / max(1, len(found))) < 0.02


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_held_out_accuracy(spark, folder):
    """The same threshold at every size of the corpus."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{folder}/{t}.parquet") for t in ("documents", "labels"))
    fitted_on = labels.where("doc_id % 2 = 0")
    rated = Q.quality_rules(docs, fitted_on).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rated)
    assert len(rated) > 100 and right >= 0.98 * len(rated)


def test_query_columns(spark):
    out = queries.op5_quality_rules(spark, SF)
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_only_short_texts(spark):
    """One partition without any text of three words."""
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([(1, "a b"), (2, "c"), (3, ""), (4, None)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["n_words"], r["n_repeat_words"]) for r in Q.quality_rules(df, labels).collect()}
    assert got == {1: (2, 0), 2: (1, 0), 3: (0, 0), 4: (0, 0)}
    one = spark.createDataFrame([(1, "a b c"), (2, "c d"), (3, "e")], "doc_id long, text string").coalesce(1)
    assert {r["n_words"] for r in Q.quality_rules(one, labels).collect()} == {1, 2, 3}


def test_buckets_grow_with_the_corpus():
    bits = [Q.bucket_bits(10 ** k) for k in range(4, 16)]
    assert bits == sorted(bits) and bits[0] == 10 and bits[2] == 13 and bits[-1] == Q.MAX_BITS
