"""Target-distribution importance resampling with bit-sliced weights.

1. Features are runs of one to three words; a feature's bucket is the CRC-32 of
   its bytes modulo ``BUCKETS``.  The CRC of a run is combined from those of
   its words (a CRC is linear: appending n bytes multiplies it by a matrix that
   depends on n alone), so that no run is ever written out.
2. Corpus and target are counted per bucket, by task, then in one sum.  The
   gain of a bucket is the scaled logarithm of its smoothed ratio.
3. A document's bucket counts become bit planes, plane k holding bit k of every
   count; the gains become planes in two's complement.  The weight is the sum
   over both of 2^(j+k) times the number of common bits (negative for the
   sign plane): exact, without a multiplication per feature.
4. Gumbel noise from a digest of the id makes the highest scores a sample
   without replacement.  Ranks come from one range partitioning by score.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from netbaseline.operators.sizing import is_small

from .bpe import sub_batches
from .common import stored
from .words import WordTable

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42
GAIN_SCALE = 1000
ROWS_A_RANGE = 1_000_000     # ranked documents per partition, about
BATCH_CHARS = 1 << 20        # texts and
BATCH_DOCS = 128             # documents whose counts are held at a time
_WORDS64 = -(-BUCKETS // 64)

WEIGHED = "n_words long, n_features long, weight long, score long"


def _byte_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """What appending n zero bytes makes of each byte of a CRC: for n below 64, and for 64, 128, 256 ..."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    one = np.array([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    small = [one]
    for _ in range(64):
        small.append((small[-1] >> np.uint32(8)) ^ step[small[-1] & np.uint32(255)])
    large = [small.pop()]
    for _ in range(30):
        large.append(_through(large[-1], large[-1]))
    return np.array(small), large


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24])


_SMALL, _LARGE = _byte_tables()
_FLAT = _SMALL.ravel()


def appended(crc: np.ndarray, more: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of x + y from those of x and y and the length of y (unsigned 32-bit arrays)."""
    at = (length & 63) << 10
    out = (_FLAT[at + (crc & 255)] ^ _FLAT[at + 256 + ((crc >> 8) & 255)]
           ^ _FLAT[at + 512 + ((crc >> 16) & 255)] ^ _FLAT[at + 768 + (crc >> 24)])
    long = np.flatnonzero(length > 63)
    for k in range(int(length[long].max() >> 6).bit_length() if len(long) else 0):
        here = long[(length[long] >> (6 + k)) & 1 == 1]
        out[here] = _through(_LARGE[k], out[here])
    return out ^ more


def _word_rows(words: list[bytes]) -> np.ndarray:
    """CRC of the word, CRC of a blank and the word, and the length of the latter."""
    return np.array([(zlib.crc32(w), zlib.crc32(b" " + w), len(w) + 1) for w in words], np.uint32).reshape(-1, 3)


def features(texts: list[str], table: WordTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of all features of some texts, and the number of words per text."""
    rows, sizes = table.of(texts)
    doc = np.repeat(np.arange(len(texts)), sizes)
    crc, tail, length = rows[:, 0], rows[:, 1], rows[:, 2].astype(np.int64)
    two = appended(crc[:-1], tail[1:], length[1:])
    three = appended(two[:-1], tail[2:], length[2:])
    in_two, in_three = doc[1:] == doc[:-1], doc[2:] == doc[:-2]
    bucket = np.concatenate([crc, two[in_two], three[in_three]]) % np.uint32(BUCKETS)
    return np.concatenate([doc, doc[1:][in_two], doc[2:][in_three]]), bucket.astype(np.int64), sizes


_tables: list[WordTable] = []


def _worker_table() -> WordTable:
    if not _tables:
        _tables.append(WordTable(_word_rows))
    return _tables[0]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for texts in sub_batches(batch["r_text"], BATCH_CHARS):
            total += np.bincount(features(texts, _worker_table())[1], minlength=BUCKETS)
    seen = np.flatnonzero(total)
    yield pd.DataFrame({"bucket": seen, "n": total[seen]})


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features per bucket over all texts: one row per bucket and task, ``BUCKETS`` sums on the driver."""
    rows = (texts.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("r_text"))
            .mapInPandas(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + 10000) / ((s + 1)(T + 10000)))) per bucket, in doubles."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(GAIN_SCALE * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _plane(bits: np.ndarray) -> np.ndarray:
    """0/1 rows of ``BUCKETS`` columns as rows of 64-bit words."""
    wide = np.zeros((len(bits), _WORDS64 * 64), np.uint8)
    wide[:, :BUCKETS] = bits
    return np.packbits(wide, axis=1).view(np.uint64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes of the gains in two's complement and the value of each; the last plane is the sign's."""
    n = max(int(gain.max()).bit_length(), int(~gain.min()).bit_length()) + 1
    value = np.array([1 << j for j in range(n)], np.int64)
    value[-1] *= -1
    return _plane(np.array([(gain >> j) & 1 for j in range(n)])), value


def weights(doc: np.ndarray, bucket: np.ndarray, n: int, planes: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The sum of gains over the features of ``n`` documents, by planes of their bucket counts."""
    counts = np.bincount(doc * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
    total = np.zeros(n, np.int64)
    for k in range(int(counts.max(initial=0)).bit_length()):
        mine = _plane((counts >> k) & 1)
        rows = np.flatnonzero(mine.any(1))
        for j in range(len(planes)):
            common = np.bitwise_count(mine[rows] & planes[j]).sum(1, dtype=np.int64)
            total[rows] += (common << k) * value[j]
    return total


def noise(name: str) -> int:
    """Scaled Gumbel noise from the first 32 bits of a digest of the id."""
    h = int(hashlib.sha256(f"{SEED}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-GAIN_SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(doc_id: Column, text: Column, gain: np.ndarray) -> Column:
    """Struct of ``WEIGHED`` for a document (null text: no words)."""
    @F.pandas_udf(WEIGHED)
    def weighed(names: pd.Series, texts: pd.Series) -> pd.DataFrame:
        planes, value = gain_planes(gain)
        n_words, n_features, weight = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in sub_batches(texts, BATCH_CHARS):
            for at in range(0, len(batch), BATCH_DOCS):
                some = batch[at:at + BATCH_DOCS]
                doc, bucket, sizes = features(some, _worker_table())
                n_words.append(sizes)
                n_features.append(np.bincount(doc, minlength=len(some)))
                weight.append(weights(doc, bucket, len(some), planes, value))
        out = pd.DataFrame({"n_words": np.concatenate(n_words), "n_features": np.concatenate(n_features),
                            "weight": np.concatenate(weight)})
        out["score"] = out["weight"] + np.fromiter(map(noise, names), np.int64, len(names))
        return out

    return weighed(F.coalesce(doc_id.cast("string"), F.lit("")), text)


def ranked(rows: DataFrame, first: int, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``rank``: place in ``order``, null beyond ``first``.

    One range partitioning; a partition's rows are numbered where they are,
    after the rows of the partitions before it.
    """
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // ROWS_A_RANGE)
    sorted_ = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # The function's upper bits are the partition, the lower 33 the place in it.
    placed = stored(sorted_.withColumn("r_at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("r_part", F.shiftright("r_at", 33)).withColumn(
        "r_place", F.col("r_at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = sorted((r["r_part"], r["n"]) for r in placed.groupBy("r_part").agg(F.count(F.lit(1)).alias("n")).collect())
    before, total = [], 0                      # one number per partition
    for part, size in sizes:
        before.append((part, total))
        total += size
    skips = spark.createDataFrame(before, "s_part long, s_skip long")
    rank = F.col("s_skip") + F.col("r_place") + 1
    return (placed.join(F.broadcast(skips) if is_small(skips) else skips, F.col("r_part") == F.col("s_part"))
            .withColumn("rank", F.when(rank <= first, rank)).drop("r_at", "r_part", "r_place", "s_part", "s_skip"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``(id, n_features, weight, score, rank)`` per document, all long.

    Null texts have no words; without features the weight is 0.  Of the N
    documents with ``min_words`` words the floor(percent * N / 100) highest
    scores have ranks 1, 2, 3...; equal scores go by id (null last).  An id of
    null gives the noise of the empty name.  Rows with equal ids are documents
    of their own with the same noise; extra columns are ignored.  With an empty
    target every target count is 0.
    """
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("r_id"), weigh(F.col(id_col), F.col(text_col), gain).alias("r"))
    rows = stored(rows.select("r_id", "r.*"), "resample-scores")
    able = rows.where(F.col("n_words") >= min_words)
    order = [F.col("score").desc(), F.col("r_id").asc_nulls_last(), F.col("n_features"), F.col("n_words")]
    drawn = ranked(able, percent * able.count() // 100, order, "resample-ranks")
    rest = rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select(F.col("r_id").alias(id_col), "n_features", "weight", "score", "rank")
