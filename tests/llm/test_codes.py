import hashlib
import math

import numpy as np
import pytest

from netbaseline.llm import queries, vector_codes as V


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Plain Lloyd's rounds in Python integers."""
    kept = [(i, [math.floor(scale * float(x)) for x in v], l) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(kept[0][1])
    cuts = [k * width // parts for k in range(parts + 1)]
    cut = [[v[a:b] for a, b in zip(cuts, cuts[1:])] for _, v, _ in kept]
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for c in cut:
                own.setdefault(nearest(c[p], books[p])[0], []).append(c[p])
            for e, xs in own.items():
                books[p][e] = [sum(col) // len(xs) for col in zip(*xs)]
    out, labels = [], {}
    for (i, _, l), c in zip(kept, cut):
        got = [nearest(x, b) for x, b in zip(c, books)]
        out.append((i, "".join(f"{e:02x}" for e, _ in got), sum(d for _, d in got), l))
        labels[l] = labels.get(l, 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, code, err, labels[l], digest) for i, code, err, l in out), key=repr)


def made(n, dim=16, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(k, [float(np.float32(x)) for x in rng.standard_normal(dim) / 4], k % 3 or None) for k in range(n)]
    rows += [(n + k, rows[3][1], 1) for k in range(n // 3)]                           # a hot vector
    rows += [(n, rows[4][1], 2), (7, rows[5][1], None), (None, rows[6][1], 1)]        # repeated ids and none
    return rows + [(9000, None, 1), (9001, [1.0, None] * (dim // 2), 1), (9002, [float("nan")] * dim, 1),
                   (9003, [float("-inf")] * dim, None)]


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block,leaf", [(4096, 16), (50, 2)])
def test_equals_brute_force(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(V, "BLOCK", block)
    monkeypatch.setattr(V, "LEAF", leaf)
    rows = made(400)
    out = V.encode_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("dim,n", [(16, 5), (10, 40), (1, 3)])
def test_few_rows_and_uneven_parts(spark, dim, n):
    rows = [(k, [float(np.float32(x)) for x in np.random.default_rng(k).standard_normal(dim)], 0) for k in range(n)]
    assert sorted(map(tuple, V.encode_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr) == brute(rows)


def test_tree_covers_and_assigns():
    """Every node holds its points within its radius, children lie apart, and subtrees go as exact distances say."""
    rng = np.random.default_rng(1)
    x = rng.integers(-3000, 3000, (3000, 4))
    x[::3] = x[0]
    tree = V.CoverTree.unpack(V.CoverTree.of(x).pack())
    assert tree.weight.sum() == 3000 and (tree.points[tree.place] == x).all()
    for k in range(len(tree.lo)):
        inside = tree.points[tree.lo[k]:tree.hi[k]]
        assert np.sqrt(((inside - inside[0]) ** 2).sum(1)).max() <= tree.radius[k] + 1e-9
        kids = range(tree.first[k], tree.first[k] + tree.kids[k])
        if len(kids):
            heads = tree.points[tree.lo[list(kids)]].astype(float)
            scale = 2.0 ** (np.ceil(np.log2(tree.radius[k])) - 1)
            gap = np.sqrt(((heads[:, None] - heads[None]) ** 2).sum(2))
            assert gap[~np.eye(len(heads), dtype=bool)].min() > scale and tree.radius[list(kids)].max() <= scale
            assert tree.hi[kids[-1]] == tree.hi[k] and tree.lo[kids[0]] == tree.lo[k]
    book = x[1:17].copy()
    book[9] = book[2]
    sums, counts, code = tree.assign(book)
    near = ((x[:, None] - book[None]) ** 2).sum(2).argmin(1)
    assert (code[tree.place] == near).all() and (counts == np.bincount(near, minlength=16)).all()
    assert all((sums[e] == x[near == e].sum(0)).all() for e in range(16))


def test_empty_odd_and_clashing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert V.encode_vectors(empty).collect() == []
    assert V.encode_vectors(spark.createDataFrame([(1, None, 2)], SCHEMA)).collect() == []
    rows = spark.createDataFrame([(1, [0.5] * 8, "a", 1), (2, [0.25] * 8, None, 2), (3, [1.0] * 4, "a", 3),
                                  (4, [3e38] * 8, None, 4)],
                                 "vec_id long, embedding array<float>, label string, code int")
    got = {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in V.encode_vectors(rows).collect()}
    assert got == {1: ("00" * 8, 0, 0), 2: ("01" * 8, 0, 0), 3: (None, None, 0), 4: (None, None, 0)}
    blank = spark.createDataFrame([(1, [], 1), (2, [], 1)], SCHEMA)
    assert {r["code"] for r in V.encode_vectors(blank).collect()} == {"00" * 8}


def test_registered_query(spark):
    import pyarrow.parquet as pq
    table = pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table]
    assert sorted(map(tuple, queries.op11_vector_codes(spark, "/root/testdata/sf0.001").collect()), key=repr) == brute(rows)
