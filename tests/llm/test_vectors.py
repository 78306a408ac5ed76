import numpy as np
import pytest

from netbaseline.llm import multi_index as M, queries


def brute(rows):
    fine = [i for i, (_, v, l) in enumerate(rows) if l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in fine}
    n, top = [0] * len(rows), list(range(len(rows)))
    for a in fine:
        for b in fine:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= M.SIMILARITY:
                n[a] += 1
                n[b] += 1
                x, y = top[a], top[b]
                top = [min(x, y) if t in (x, y) else t for t in top]
    least = {t: min(rows[k][0] for k in range(len(rows)) if top[k] == t) for t in set(top)}
    return sorted((rows[k][0], n[k], least[top[k]]) for k in range(len(rows)))


def made(n=300, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        v = rng.standard_normal(dim)
        rows.append((4 * k, [float(np.float32(x)) for x in v], k % 3))
        if k % 4 == 0:
            near = v / np.linalg.norm(v) + 0.12 * rng.standard_normal(dim) / dim ** 0.5
            rows.append((4 * k + 1, [float(np.float32(x)) for x in near], k % 3))
        if k % 10 == 0:
            rows += [(4 * k + 2, rows[-1][1], k % 3), (4 * k + 3, [2 * x for x in rows[-1][1]], (k + 1) % 3)]
    return rows


@pytest.mark.parametrize("recall,cell_rows,block", [(1.0, 5, 4096), (1.0, 400, 8), (M.TARGET_RECALL, 5, 4096)])
def test_equals_brute_force(spark, monkeypatch, recall, cell_rows, block):
    monkeypatch.setattr(M, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(M, "BLOCK_ROWS", block)
    rows = made() + [(9000, None, 1), (9001, [0.0] * 16, 1), (9002, [1.0, None] * 8, 1), (9003, [float("nan")] * 16, 1),
                     (9004, [float("inf")] * 16, 1), (9005, [1.0] * 16, None), (9006, [], 1), (9007, [1.0, 2.0], 1),
                     (9008, [2.0, 4.0], 1), (9009, [-0.0, 1.0], 1), (9010, [0.0, 1.0], 1), (9011, [1e-30] * 16, 2), (9012, [3e37] * 16, 2)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, kept string")
    out = M.vector_links(df, recall=recall).collect()
    got, want = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out), brute(rows)
    if recall == 1.0:
        assert got == want
    else:
        assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want)
        assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)


def test_nothing_to_compare(spark):
    df = spark.createDataFrame([(1, None, 1), (None, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted((str(r["vec_id"]), r["n_links"], r["kept"]) for r in M.vector_links(df).collect()) == [("1", 0, True), ("None", 0, True)]
    assert M.vector_links(df.where("false")).collect() == []


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    out = queries.op6_embedding_dedup(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out) == brute([tuple(r) for r in rows])


def test_repeated_ids(spark):
    """Different vectors of one id, also under different labels, are vectors of their own."""
    a, b = [1.0] + [0.0] * 7, [0.0] * 7 + [1.0]
    rows = [(1, a, 1), (1, b, 1), (2, a, 1), (3, a, 2), (3, b, 3), (4, b, 3), (None, a, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in M.vector_links(df).collect()), key=repr)
    assert got == sorted([(1, 1, 1, True), (1, 0, 1, True), (2, 1, 1, False), (3, 0, 3, True), (3, 1, 3, True), (4, 1, 3, False),
                          (None, 0, None, True)], key=repr)
