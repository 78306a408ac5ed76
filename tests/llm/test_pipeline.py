import hashlib
from collections import Counter

import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as P
from netbaseline.llm import mixing, quality
from netbaseline.llm.common import ship_package
from tests.llm.test_jaccard import shingles

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs, library = spark.read.parquet(f"{SF}/documents.parquet"), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    columns, seen = docs.columns, {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        if name != "bpe":
            assert out.columns == columns
        seen[name] = (docs, out)
        docs = spark.createDataFrame(out.collect(), out.schema)
    before, after = seen["quality_rules"]
    kept = {r["doc_id"] for r in quality.quality_rules(before, spark.read.parquet(f"{SF}/labels.parquet")).where("kept").collect()}
    assert {r["doc_id"] for r in after.collect()} == kept
    before, after = (x.collect() for x in seen["line_dedup"])
    lines = Counter(x.strip(" \t\r").lower() for r in after for x in r["text"].split("\n") if len(x.strip()) >= 16)
    assert max(lines.values()) == 1 and len(after) <= len(before)
    before, after = (x.collect() for x in seen["jaccard_join"])
    sets = {r["doc_id"]: shingles(r["text"], 5) for r in after}
    ids = sorted(i for i in sets if sets[i])
    for a in ids:
        for b in ids:
            if a < b:
                c = len(sets[a] & sets[b])
                assert 100 * c < 80 * (len(sets[a]) + len(sets[b]) - c)
    before, after = seen["mixing"]
    want = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(before).collect()}
    assert Counter(r["doc_id"] for r in after.collect()) == Counter({k: n for k, n in want.items() if n})
    before, after = (x.collect() for x in seen["bpe"])
    texts = {r["doc_id"]: r["text"] for r in before}
    assert len(before) == len(after)
    for r in after:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_registered(spark):
    names = set(E.queries())
    assert {"pipeline"} <= names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert E.queries()["pipeline"](spark, SF).count() > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_batches_of_long_texts_are_bounded(spark):
    """40 texts of 100 KB go to a Python worker in several batches."""
    ship_package(spark)
    texts = spark.range(0, 40, 1, 1).select(F.expr("repeat('a', 100000)").alias("t"))
    sizes = [r["n"] for r in texts.mapInPandas(lambda it: (pd.DataFrame({"n": [len(b)]}) for b in it), "n int").collect()]
    assert sum(sizes) == 40 and max(sizes) <= 12
