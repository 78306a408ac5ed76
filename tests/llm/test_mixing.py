import hashlib
import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from netbaseline.llm import mixing, queries

SF = "/root/testdata/sf0.001"


def targets(sizes: dict) -> dict:
    """Brute force: share out, cap, share out the excess again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in rest)
        share = {s: left * weight[s] / w for s in rest} if w else {}
        more = {s for s in rest if share[s] > 3 * sizes[s]}
        if not more:
            return {s: 3.0 * sizes[s] if s in capped else share[s] for s in names}
        capped |= more


ROWS = ([(i, "w " * (i % 40), "big") for i in range(900)] + [(i, "a b c", "Small") for i in range(900, 905)]
        + [(i, "x " * 50, None) for i in range(905, 925)] + [(i, None, "empty") for i in range(925, 930)]
        + [(None, "no id here", "big"), (7, "same id", "big"), (7, "same id", "big"), (930, "\u00e9t\u00e9 " * 30, "\U00010000")])


@pytest.mark.parametrize("bucket_rows", [1_000_000, 100])
def test_mix(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "ROWS_A_BUCKET", bucket_rows)
    df = spark.createDataFrame([(*r, 1.0) for r in ROWS], "doc_id long, text string, source string, target double")
    out = mixing.mix_sources(df, carry=True).collect()
    assert len(out) == len(ROWS)
    sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in out:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r["row"]["text"] or ""))
        s = r["row"]["source"]
        assert r["size"] == n and 0 <= r["taken"] <= 3 * n and r["taken"] == r["copies"] * n
        sizes[s] += n
        taken[s] += r["taken"]
        most[s] = max(most[s], n)
    want = targets(dict(sizes))
    for r in out:
        assert r["source_size"] == sizes[r["row"]["source"]]
        assert r["target"] == pytest.approx(want[r["row"]["source"]])
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2 * most[s] + 1
    again = mixing.mix_sources(df.repartition(5), carry=True).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_mixed_documents_repeat_rows(spark):
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, source string, copies int")
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    assert mixed.count() == mixing.mix_sources(df).agg(F.sum("copies")).first()[0]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_sources(df).collect() == []


def test_query_near_targets(spark):
    out = queries.op10_mixing(spark, SF)
    by = out.groupBy("source_size", "target").agg(F.sum("taken").alias("t"), F.max("size").alias("m")).collect()
    assert all(abs(r["t"] - r["target"]) <= 2 * r["m"] for r in by)


@pytest.mark.parametrize("bucket_rows", [1_000_000, 100, 7])
def test_order_of_equal_sizes(spark, monkeypatch, bucket_rows):
    """Row by row the systematic sample by (size, id) of every source, as in the SQL, for buckets of any size."""
    monkeypatch.setattr(mixing, "ROWS_A_BUCKET", bucket_rows)
    rows = [(i * 37 % 1009, "w " * (1 + i % 3), "ab"[i % 4 == 0]) for i in range(600)] + [(None, "w w", "a"), (-5, "w w", "a")]
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), carry=True).collect()
    for source in "ab":
        mine = sorted((r for r in out if r["row"]["source"] == source),
                      key=lambda r: (r["size"], r["doc_id"] is not None, r["doc_id"] or 0))
        digest = hashlib.md5(f"{mixing.SEED}|s{source}".encode()).hexdigest()
        u, rate = int(digest[:5], 16) / (1 << 20), mine[0]["target"] / mine[0]["source_size"]
        want = [math.floor(u + rate * k) - math.floor(u + rate * (k - 1)) for k in range(1, len(mine) + 1)]
        assert [r["copies"] for r in mine] == want
