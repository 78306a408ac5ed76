import hashlib
import math
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from netbaseline.llm import queries, resampling as R, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=5):
    s, t, parts = [0] * 10000, [0] * 10000, []
    for _, text in docs:
        parts.append(grams(text))
        for b in parts[-1][1]:
            s[b] += 1
    for text in target:
        for b in grams(text)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + 10000) / ((x + 1) * (sum(t) + 10000)))) for x, y in zip(s, t)]
    rows = []
    for (i, _), (n, f) in zip(docs, parts):
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((k for k, r in enumerate(rows) if r[4] >= 20),
                  key=lambda k: (-rows[k][3], rows[k][0] is None, rows[k][0] or 0, rows[k][1], rows[k][4]))
    rank = {k: p for p, k in enumerate(able[:percent * len(able) // 100], 1)}
    return sorted((r[:4] + (rank.get(k),) for k, r in enumerate(rows)), key=repr)


def made(n=300, seed=2):
    rnd = random.Random(seed)
    pool = ["the", "Of", "wörd", "日本語", "x1", "Zebra", "a", "e" * 90] + [f"w{k}" for k in range(200)]
    docs = [(k, rnd.choice([" ", "\n", "-", ". "]).join(rnd.choice(pool) for _ in range(rnd.randrange(70)))) for k in range(n)]
    docs += [(n + k, docs[5][1]) for k in range(40)] + [(3, docs[9][1]), (3, docs[9][1]), (None, docs[7][1]), (None, None), (900, None), (901, "")]
    docs.append((902, " ".join(rnd.choice(pool) for _ in range(30_000))))
    return docs, [" ".join(rnd.choice(pool[:60]) for _ in range(30)) for _ in range(20)] + [None, ""]


@pytest.mark.parametrize("percent,piece", [(5, 1 << 20), (60, 200)])
def test_equals_brute_force(spark, monkeypatch, percent, piece):
    monkeypatch.setattr(words, "PIECE_BYTES", piece)
    docs, target = made()
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as rank", "'x' as bucket").repartition(4)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    out = R.resample(d, t, percent=percent)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {f.dataType.simpleString() for f in out.schema.fields} == {"bigint"}
    assert sorted(map(tuple, out.collect()), key=repr) == brute(docs, target, percent)


def test_empty_tables(spark):
    d, t = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "text string")
    assert R.resample(d, t).collect() == []
    docs = [(k, "one two three " * 10) for k in range(30)]
    full = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, R.resample(full, t).collect()), key=repr) == brute(docs, [])


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()]
    target = [r["text"] for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist()]
    assert sorted(map(tuple, queries.op12_resampling(spark, folder).collect()), key=repr) == brute(docs, target)
