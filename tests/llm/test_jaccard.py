import re
from collections import Counter

import pandas as pd
import pytest

from netbaseline.llm import components, jaccard_groups as J

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute(rows, width, percent):
    rows = [(d, min(t for e, t in rows if e == d) if d is not None and sum(e == d for e, _ in rows) > 1 else t) for d, t in rows]
    sets = [shingles(t, width) for _, t in rows]
    top = list(range(len(rows)))

    def join(i, j):
        nonlocal top
        a, b = top[i], top[j]
        top = [min(a, b) if t in (a, b) else t for t in top] if a != b else top

    for i, (d, _) in enumerate(rows):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and None not in (d, rows[j][0]) and 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c) or d is not None and d == rows[j][0]:
                join(i, j)
    least = {t: min((rows[k][0] for k in range(len(rows)) if top[k] == t and rows[k][0] is not None), default=None) for t in set(top)}
    return sorted(str((d, len(sets[k]), least[top[k]] if d is not None else None)) for k, (d, _) in enumerate(rows))


def made():
    base = [f"w{k * 37 % 101} v{k}" for k in range(40)]
    rows = [(1, " ".join(base)), (2, "  " + " ".join(base).upper() + "\n"), (3, None), (4, ""), (5, " \n\t"), (6, "one two"), (7, "One  TWO"),
            (8, "two one"), (9, "x"), (None, "x"), (None, " ".join(base)), (10, "Été a b"), (11, "été a b"), (12, "a　b c d"),
            (14, "long " * 9000), (15, "long " * 3)]
    for k in range(30):                      # a chain: each a little further from the base
        words = list(base)
        for j in range(k):
            words[-1 - j] = f"c{j}"
        rows.append((20 + k, " ".join(words)))
    common = " ".join(f"common{k}" for k in range(25))
    rows += [(100 + k, common + " " + " ".join(f"own{k}x{j}" for j in range(25))) for k in range(40)]
    rows += [(200 + k, common + f" tail{k}") for k in range(12)]
    rows += [(300, "first text of a repeated id one two three"), (300, "second text of a repeated id four five six"),
             (301, "second text of a repeated id four five six")]
    return rows


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("seeds,block", [(True, 4096), (True, 4), (False, 4096)])
def test_equals_brute_force(spark, monkeypatch, width, percent, seeds, block):
    """With and without the MinHash proposals, and with groups cut into blocks: the matrix finds what is between groups."""
    monkeypatch.setattr(J, "GROUP_ROWS", block)
    if not seeds:
        monkeypatch.setattr(J, "_seed_pairs", lambda reps: reps.where("false").selectExpr("rep as a", "rep as b"))
    rows = made()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    out = J.jaccard_components(df, width=width, percent=percent).collect()
    assert sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in out) == brute(rows, width, percent)


def test_test_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    out = J.jaccard_components(docs).collect()
    assert sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in out) == brute(rows, 3, 90)


def test_one_of_each(spark):
    rows = made()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    kept = J.one_of_each(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 3 in ids and ids.count(None) == 2 and 301 in ids and ids.count(300) == 2
    assert J.one_of_each(df.where("false")).collect() == []


def test_components(spark):
    edges = [(k, k + 1) for k in range(200, 260)] + [(5, 9), (9, 5), (7, 7), (9, 1), (3, None)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    assert got == {k: 200 for k in range(200, 261)} | {1: 1, 5: 1, 9: 1}


def test_counts_leave_a_task_packed():
    """Many documents in every hash range: rows of a task are as many as parts, not as documents."""
    texts = [f"common words of all texts {k} and more common words" for k in range(300)]
    batch = pd.DataFrame({"rep": range(300), "grp": range(300), "j_text": texts})
    packed = pd.concat(J._pack(3, 64)(iter([batch.iloc[:150], batch.iloc[150:]]))).sort_values("bucket")
    counted = pd.concat(J._count_shared(4)(iter([packed])))
    assert len(counted) == 4
    got = pd.concat(J._sum_shared(iter([pd.concat([counted, counted]).sort_values("part")]))).set_index("rep")["shared"]
    sets = [set(s.tolist()) for s in J.token_sets(texts, 3)]
    times = Counter(t for s in sets for t in s)
    assert got.to_dict() == {k: 2 * sum(times[t] > 1 for t in s) for k, s in enumerate(sets)}
