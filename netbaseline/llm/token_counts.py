"""Token counts of whole texts, huge documents by overlap resynchronisation.

A text of up to ``chunk_chars`` characters is encoded as it is.  A longer one
is cut into overlapping chunks that are dealt out over the cluster as rows of
their own; every chunk reports its token count and the stable boundaries in
its two overlaps.  A boundary is stable where a run of blanks begins after
other text: the split pattern never matches across it and never looks behind
it, so that two encodings with such a boundary in common agree from there on.
Neighbouring chunks are spliced at the last one they share.  Where an overlap
has none (say, one word of 100,000 letters), overlap and chunk are widened
eightfold for that document, in the end to the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from .bpe import load, sub_batches
from .common import stored

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
WIDEN = 8

CHUNK_ROWS = "k_id long, k_sha string, k_no long, k_from long, k_last boolean, k_text string"
SUMMARY_ROWS = ("k_id long, k_sha string, k_no long, k_tokens long, head_at array<long>, head_n array<long>, "
                "tail_at array<long>, tail_n array<long>")
SPLICED_ROWS = "k_id long, k_sha string, k_total long"


def count_small(text: Column, path: str) -> Column:
    """Token counts of texts that are encoded in one piece (null: 0)."""
    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([len(ids) // 4 for batch in sub_batches(texts) for ids in bpe.encode_batch(batch)],
                         dtype="int64")

    return count(text)


def _cut(chunk: int, overlap: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, sha, text in batch.itertuples(index=False):
                step = chunk - overlap
                starts = range(0, max(1, len(text) - overlap), step)
                for k, a in enumerate(starts):
                    yield pd.DataFrame({"k_id": pd.array([i], "Int64"), "k_sha": [sha], "k_no": [k], "k_from": [a],
                                        "k_last": [k + 1 == len(starts)], "k_text": [text[a:a + chunk]]})
    return cut


def chunk_summary(bpe, text: str, start: int, last: bool, overlap: int) -> tuple:
    """Tokens of a chunk and (offset, tokens before it) of the boundaries in its overlaps."""
    units = bpe.segments(text)
    encoded = bpe.encode_units([units])[0]
    guard = max(map(len, bpe.special), default=0)
    end = start + len(text)
    at, n, head, tail = start, 0, [], []
    for unit, ids in zip(units, encoded):
        # A unit begins a run of blanks after other text, a special string, or the chunk.
        if at <= start + overlap:
            head.append((at, n))
        if not last and at > start and end - overlap <= at <= end - guard and (unit[0].isspace() or unit in bpe.special):
            tail.append((at, n))
        at, n = at + len(unit), n + len(ids) // 4
    return n, head, tail


def _summarise(path: str, overlap: int):
    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for batch in batches:
            rows = []
            for i, sha, no, start, last, text in batch.itertuples(index=False):
                n, head, tail = chunk_summary(bpe, text, start, last, overlap)
                rows.append((i, sha, no, n, *([x[j] for x in side] for side in (head, tail) for j in (0, 1))))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in SUMMARY_ROWS.split(", ")])
            yield out.assign(k_id=out["k_id"].astype("Int64"))
    return summarise


def splice(chunks: list[tuple]) -> int | None:
    """Total of ``(tokens, head_at, head_n, tail_at, tail_n)`` in order; None: some overlap has no common boundary."""
    total, before = chunks[0][0], chunks[0]
    for now in chunks[1:]:
        heads = dict(zip(now[1], now[2]))
        common = [(at, n) for at, n in zip(before[3], before[4]) if at in heads]
        if not common:
            return None
        at, n = common[-1]
        total += (now[0] - heads[at]) - (before[0] - n)
        before = now
    return total


def _splice_group(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.drop_duplicates("k_no").sort_values("k_no")
    columns = ("k_tokens", "head_at", "head_n", "tail_at", "tail_n")
    total = splice([tuple(x) for x in rows[list(columns)].itertuples(index=False)])
    return pd.DataFrame({"k_id": pd.array([rows["k_id"].iloc[0]], "Int64"), "k_sha": [rows["k_sha"].iloc[0]],
                         "k_total": pd.array([total], "Int64")})


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """``(id, n_bytes, n_tokens)`` per row of ``docs``, as the file's library counts them.

    A null text counts as empty (0, 0).  Rows with equal ids, null ids and
    extra columns are allowed: every input row gives one output row.  A task
    holds one text or the chunks of one Arrow batch; a huge document costs one
    small summary row per chunk where it is spliced.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("k_id"), F.coalesce(F.col(text_col), F.lit("")).alias("k_text"))
    size = F.octet_length("k_text").cast("long").alias("n_bytes")
    small = docs.where(F.length("k_text") <= chunk_chars).select(
        F.col("k_id").alias(id_col), size, count_small(F.col("k_text"), path).alias("n_tokens"))
    huge = docs.where(F.length("k_text") > chunk_chars).withColumn("k_sha", F.sha2("k_text", 256))
    todo, totals, chunk, overlap = huge, None, chunk_chars, overlap_chars
    while True:
        chunks = (todo.select("k_id", "k_sha", "k_text").mapInPandas(_cut(chunk, overlap), CHUNK_ROWS)
                  .repartition("k_id", "k_sha", "k_no"))
        spliced = stored(chunks.mapInPandas(_summarise(path, overlap), SUMMARY_ROWS)
                         .groupBy("k_id", "k_sha").applyInPandas(_splice_group, SPLICED_ROWS), "token-counts")
        done = spliced.where("k_total is not null")
        totals = done if totals is None else totals.unionByName(done)
        failed = spliced.where("k_total is null").select(F.col("k_id").alias("f_id"), F.col("k_sha").alias("f_sha"))
        if failed.isEmpty():
            break
        overlap *= WIDEN
        chunk = max(chunk * 2, 4 * overlap)
        todo = huge.join(failed, huge.k_id.eqNullSafe(failed.f_id) & (huge.k_sha == failed.f_sha), "left_semi")
    totals = totals.select(F.col("k_id").alias("f_id"), F.col("k_sha").alias("f_sha"), "k_total")
    whole = (huge.join(totals, huge.k_id.eqNullSafe(totals.f_id) & (huge.k_sha == totals.f_sha))
             .select(F.col("k_id").alias(id_col), size, F.col("k_total").alias("n_tokens")))
    return small.unionByName(whole)
