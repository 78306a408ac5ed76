"""A training-data pipeline over ``documents`` in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of ``documents``.

1. quality rules: documents that fail them go;
2. line dedup: repeated lines go, and documents of which nothing is left;
3. n-gram Jaccard join: five words, similarity 0.8; one document of a group stays;
4. mixing: documents are taken, some repeatedly, towards the sources' target weights;
5. BPE: token ids, and digests of the ids and of the text decoded from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from netbaseline.llm import bpe, jaccard_groups, line_dedup, mixing, quality
from netbaseline.llm.common import read_table, ship_package, stored
from netbaseline.llm.queries import TOKENIZER


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.keep_quality(docs, read_table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return jaccard_groups.one_of_each(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    coded = docs.select("doc_id", "source", bpe.bpe_round_trip(F.col("text"), TOKENIZER).alias("b"))
    both = coded.select("doc_id", "source", "b.*")
    return both.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("jaccard_join", jaccard_join),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Trained scores, MinHash and BPE are beyond SQL; tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
