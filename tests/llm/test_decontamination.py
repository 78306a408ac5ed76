import random
import re

import pytest

from netbaseline.llm import decontamination as D, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    wanted = {}
    for name, text in items:
        w = split(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            wanted.setdefault(tuple(w[i:i + k]), set()).add("" if name is None else str(name))
    out = []
    for i, text in docs:
        w, hit, met = split(text), set(), set()
        for k in {len(s) for s in wanted}:
            for p in range(len(w) - k + 1):
                if tuple(w[p:p + k]) in wanted:
                    hit.update(range(p, p + k))
                    met |= wanted[tuple(w[p:p + k])]
        out.append((i, len(w), len(hit), sorted(met)))
    return sorted(out, key=repr)


def made(seed=4):
    rnd = random.Random(seed)
    pool = ["a", "B", "cé", "日本", "d1"] + [f"w{k}" for k in range(60)]
    text = lambda n: [rnd.choice(pool) for _ in range(n)]
    items = [(k, " ".join(text(rnd.randrange(10, 40)))) for k in range(12)]
    items += [(12, items[0][1] + " more words"), (13, "w1 w2 w3 w4"), (14, "w1 W2  w3-w4"), (15, "q9"), (16, ""), (17, None),
              (18, " ".join(text(9))), (None, " ".join(text(25))), (3, " ".join(text(15))), (19, "a a a a a a a a a a a a a a")]
    docs = []
    for k in range(150):
        w = text(rnd.randrange(0, 90))
        if k % 3 == 0:                                     # spans of 8 to 14 words of an item, at any place of it
            v = rnd.choice([i for i in items if i[1]])[1].split()
            at = rnd.randrange(len(v))
            w[len(w) // 2:len(w) // 2] = v[at:at + rnd.randrange(8, 15)]
        docs.append((k, rnd.choice([" ", "\n", ", "]).join(w).title()))
    docs += [(500, items[0][1]), (501, "a " * 30), (502, "w1 w2 w3 w4 q9 " * 4), (503, None), (504, ""), (7, docs[3][1]), (7, items[1][1]),
             (None, items[2][1]), (None, None), (505, " ".join(text(20_000)) + " " + items[5][1])]
    return docs + [(600 + k, items[0][1]) for k in range(40)], items


@pytest.mark.parametrize("max_index,piece", [(D.MAX_INDEX, 1 << 20), (D.MAX_INDEX, 100), (0, 1 << 20)])
def test_equals_brute_force(spark, monkeypatch, max_index, piece):
    monkeypatch.setattr(words, "PIECE_BYTES", piece)
    docs, items = made()
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_hit", "'x' as item_id").repartition(3)
    t = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 as doc_id")
    out = D.benchmark_hits(d, t, max_index=max_index)
    assert sorted(((r[0], r[1], r[2], list(r[3])) for r in out.collect()), key=repr) == brute(docs, items)


def test_every_span_of_a_window_is_found():
    """Shared spans of exactly ten words, at every place of an item."""
    item = [f"i{k}" for k in range(25)]
    index = D.Index(["x"], [" ".join(item)])
    for at in range(len(item) - 9):
        got = D._found(["before this " + " ".join(item[at:at + 10]) + " and after", " ".join(item[at:at + 9])], index)
        assert got["n_hit"].tolist() == [10, 0] and list(got["items"]) == [["x"], []]


def test_winnowing_keeps_few_fingerprints():
    rnd = random.Random(1)
    marks = D.Texts([" ".join(str(rnd.randrange(10 ** 12)) for _ in range(20_000))]).windows(10)[1]
    assert 0.25 < len(set(marks.tolist())) / 20_000 < 0.32            # 2 / 7


def test_empty_tables_and_removal(spark):
    d, t = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, "c d"), (None, "e")], "doc_id long, text string")
    item = spark.createDataFrame([(1, "C")], "item_id long, text string")
    for most in (D.MAX_INDEX, -1):
        assert D.benchmark_hits(d, item, max_index=most).collect() == []
        assert sorted(map(tuple, D.benchmark_hits(some, t, max_index=most).collect()), key=repr) == [(1, 2, 0, []), (2, 2, 0, []), (None, 1, 0, [])]
        assert sorted(r["text"] for r in D.without_leaks(some, item, max_index=most).collect()) == ["a b", "e"]
