"""Benchmark decontamination by winnowing.

1. Texts become word hashes.  The fingerprint of a window of ``WINDOW`` words
   is the smallest of its hashes of ``GRAM`` words (the last of equals).
   Equal windows have equal fingerprints, so that every shared span of
   ``WINDOW`` words or more has one in common, while neighbouring windows mostly
   share theirs: a text of n words keeps about 2 n / 7.  An item of fewer words is
   one window and its own fingerprint; documents keep the hashes of runs of those lengths too.
2. Fingerprints of documents and items are joined.  An index of up to
   ``MAX_INDEX`` item words is broadcast, and documents are looked up where they are read:
   one scan, no shuffle.  A larger one is joined by shuffles.
3. Hits are extended: around a fingerprint met, all windows that it stands for
   are compared, and those that an item has mark their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .bpe import sub_batches
from .common import stored
from .words import WordTable

WINDOW, GRAM = 10, 5
MAX_INDEX = 2_000_000        # words of items in a broadcast index (some 30 bytes each)
BATCH_CHARS = 1 << 20

_M = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M[1]
    h = (h ^ (h >> np.uint64(27))) * _M[2]
    return h ^ (h >> np.uint64(31))


def _word_rows(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


_tables: list[WordTable] = []


def _worker_table() -> WordTable:
    if not _tables:
        _tables.append(WordTable(_word_rows))
    return _tables[0]


def runs(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of the n words from every place on; ``salt`` makes another hash of the same words."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        out += _mix(h[k:k + len(out)] + np.uint64((k + 1 + 1000 * n + 100_000 * salt) * int(_M[0]) & (1 << 64) - 1))
    return _mix(out)


def fingerprints(h: np.ndarray) -> np.ndarray:
    """Fingerprint of the window from every place on: the smallest of its hashes of ``GRAM`` words."""
    gram = runs(h, GRAM)
    n = max(0, len(h) - WINDOW + 1)
    out = gram[:n].copy()
    for k in range(1, WINDOW - GRAM + 1):
        np.minimum(out, gram[k:k + n], out=out)
    return out


class Texts:
    """Word hashes of some texts and the windows of each length in them."""

    def __init__(self, texts: list[str]):
        self.h, self.sizes = _worker_table().of(texts)
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)

    def places(self, length: int) -> np.ndarray:
        """Where a window of the length starts that ends in the same text."""
        last = len(self.h) - length + 1
        return np.flatnonzero(self.doc[:last] == self.doc[length - 1:]) if last > 0 else np.zeros(0, np.int64)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and fingerprint of the windows of a length."""
        at = self.places(length)
        return at, (fingerprints(self.h) if length == WINDOW else runs(self.h, length))[at]


def item_windows(items: list[str]) -> pd.DataFrame:
    """(item number, length, fingerprint, second hash) of all windows of the items; both hashes as signed longs."""
    found = Texts(items)
    of, out = found.sizes[found.doc], []
    for length in range(1, WINDOW + 1):
        at, mark = found.windows(length)
        own = (of[at] == length) if length < WINDOW else np.ones(len(at), bool)
        at, mark = at[own], mark[own]
        out.append(pd.DataFrame({"item": found.doc[at], "length": length, "mark": mark.view(np.int64),
                                 "whole": runs(found.h, length, 1)[at].view(np.int64)}))
    return pd.concat(out, ignore_index=True)


class Index:
    """The distinct windows of all items, by length and fingerprint, and the set of items of each."""

    def __init__(self, ids: list[str], texts: list[str]):
        rows = item_windows(texts)
        rows["id"] = np.array(ids, object)[rows["item"]] if len(rows) else []
        sets = rows.groupby(["length", "mark", "whole"], sort=True)["id"].agg(lambda s: tuple(sorted(set(s)))).reset_index()
        self.of = {length: (part["mark"].to_numpy(np.int64).view(np.uint64), part["whole"].to_numpy(np.int64).view(np.uint64), list(part["id"]))
                   for length, part in sets.groupby("length")}

    def hits(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, list[tuple[str, ...]]]:
        """Per word whether it is inside an item's window; of every window met its text and its items."""
        edge, docs, items = np.zeros(len(texts.h) + 1, np.int64), [np.zeros(0, np.int64)], []
        for length, (marks, wholes, sets) in self.of.items():
            at, mark = texts.windows(length)
            known, heads = np.sort(marks), np.flatnonzero(np.r_[True, mark[1:] != mark[:-1]][:len(mark)])
            kept = mark[heads]                       # neighbouring windows mostly share their fingerprint
            met = known[np.minimum(np.searchsorted(known, kept), len(known) - 1)] == kept
            near = np.repeat(met, np.diff(np.r_[heads, len(mark)]))
            at, mark = at[near], mark[near]          # the windows around a fingerprint met
            for place, which in _extended(texts.h, at, mark, length, marks, wholes):
                np.add.at(edge, place, 1)
                np.add.at(edge, place + length, -1)
                docs.append(texts.doc[place])
                items += [sets[k] for k in which]
        return np.cumsum(edge[:-1]) > 0, np.concatenate(docs), items


def _extended(h, at, mark, length, marks, wholes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, windows) of the candidates that equal a window: all their words are hashed again and compared."""
    if not len(at):
        return
    whole = runs(h, length, 1)[at]
    key, own = _mix(marks * _M[0] ^ wholes), _mix(mark * _M[0] ^ whole)
    order = np.argsort(key)
    k = order[np.minimum(np.searchsorted(key[order], own), len(key) - 1)]
    same = (marks[k] == mark) & (wholes[k] == whole)
    yield at[same], k[same]


FOUND = "n_words long, n_hit long, items array<string>"


def _found(texts: list[str], index: Index) -> pd.DataFrame:
    t = Texts(texts)
    hit, docs, sets = index.hits(t)
    items: list[set[str]] = [set() for _ in texts]
    seen = set()
    for d, s in zip(docs.tolist(), sets):
        if (d, s) not in seen:                       # many windows of a text have one set of items
            seen.add((d, s))
            items[d].update(s)
    return pd.DataFrame({"n_words": t.sizes, "n_hit": np.bincount(t.doc[hit], minlength=len(texts)),
                         "items": [sorted(s) for s in items]})


def _looked_up(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents met with a broadcast index, ``(d_id, n_words, n_hit, items)``."""
    rows = items.collect()                           # at most MAX_INDEX words
    index = docs.sparkSession.sparkContext.broadcast(Index([r["i_id"] for r in rows], [r["i_text"] for r in rows]))

    @F.pandas_udf(FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        parts = [_found(batch, index.value) for batch in sub_batches(texts, BATCH_CHARS)]
        return pd.concat(parts, ignore_index=True) if parts else _found([], index.value)

    return docs.select("d_id", found("d_text").alias("f")).select("d_id", "f.*")


def _joined(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The same by shuffles, for any number of items.

    Documents of equal id and text are one key.  Of every document only its
    distinct fingerprints travel; texts only of documents that share one.
    """
    def windows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = 0
            for texts in sub_batches(batch["i_text"], BATCH_CHARS):
                rows = item_windows(texts)
                rows["i_id"] = batch["i_id"].iloc[at:at + len(texts)].to_numpy()[rows["item"]] if len(rows) else []
                at += len(texts)
                yield rows[["i_id", "length", "mark", "whole"]]

    known = stored(items.mapInPandas(windows_of, "i_id string, length int, mark long, whole long").distinct(), "leak-windows")
    lengths = sorted(r[0] for r in known.select("length").distinct().collect())      # at most WINDOW numbers

    def marks_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = 0
            for texts in sub_batches(batch["d_text"], BATCH_CHARS):
                t, own = Texts(texts), batch.iloc[at:at + len(texts)]
                at += len(texts)
                for length in lengths:
                    place, mark = t.windows(length)
                    rows = pd.DataFrame({"k": t.doc[place], "mark": mark.view(np.int64)}).drop_duplicates()
                    yield pd.DataFrame({"k_id": own["d_name"].to_numpy()[rows["k"]], "k_hash": own["d_hash"].to_numpy()[rows["k"]],
                                        "length": length, "mark": rows["mark"]})

    def windows_met(texts: list[str], near: list) -> tuple[np.ndarray, list[list[tuple[int, int, int]]]]:
        """Hit words per text, and (length, mark, whole) of the windows met; ``near``: candidates per text."""
        hit, met = [], []
        for text, rows in zip(texts, near):
            t, edge, own = Texts([text]), None, []
            edge = np.zeros(len(t.h) + 1, np.int64)
            rows = [] if rows is None else rows
            for length in sorted({r["length"] for r in rows}):
                some = [r for r in rows if r["length"] == length]
                marks, wholes = (np.array([r[c] for r in some], np.int64).view(np.uint64) for c in ("mark", "whole"))
                at, mark = t.windows(length)
                for place, which in _extended(t.h, at, mark, length, marks, wholes):
                    np.add.at(edge, place, 1)
                    np.add.at(edge, place + length, -1)
                    own += [(length, some[k]["mark"], some[k]["whole"]) for k in np.unique(which)]
            hit.append(int((np.cumsum(edge[:-1]) > 0).sum()))
            met.append(own)
        return np.array(hit, np.int64), met

    @F.pandas_udf("n_hit long, met array<struct<length: int, mark: long, whole: long>>")
    def compared(texts: pd.Series, near: pd.Series) -> pd.DataFrame:
        hit, met = windows_met(list(texts), list(near))
        return pd.DataFrame({"n_hit": hit, "met": [[dict(zip(("length", "mark", "whole"), m)) for m in own] for own in met]})

    @F.pandas_udf("long")
    def size(texts: pd.Series) -> pd.Series:
        return pd.Series([n for batch in sub_batches(texts, BATCH_CHARS) for n in Texts(batch).sizes], dtype="int64")

    docs = docs.withColumn("d_hash", F.xxhash64("d_text")).withColumn("d_name", F.col("d_id").cast("string"))
    marks = docs.select("d_name", "d_hash", "d_text").mapInPandas(marks_of, "k_id string, k_hash long, length int, mark long")
    same = F.col("d_name").eqNullSafe(F.col("k_id")) & (F.col("d_hash") == F.col("k_hash"))
    near = (marks.join(known.select("length", "mark", "whole").distinct(), ["length", "mark"])
            .groupBy("k_id", "k_hash").agg(F.collect_set(F.struct("length", "mark", "whole")).alias("near")))
    texts = docs.dropDuplicates(["d_id", "d_hash"])
    met = stored(texts.join(near, same).select("k_id", "k_hash", compared("d_text", "near").alias("c"))
                 .select("k_id", "k_hash", "c.*"), "leak-hits")
    items_of = (met.select("k_id", "k_hash", F.explode("met").alias("m")).select("k_id", "k_hash", "m.*")
                .join(known, ["length", "mark", "whole"]).select("k_id", "k_hash", "i_id").distinct()
                .groupBy("k_id", "k_hash").agg(F.array_sort(F.collect_list("i_id")).alias("items")))
    of = met.select("k_id", "k_hash", "n_hit").join(
        items_of.select(F.col("k_id").alias("o_id"), F.col("k_hash").alias("o_hash"), "items"),
        F.col("k_id").eqNullSafe(F.col("o_id")) & (F.col("k_hash") == F.col("o_hash"))).drop("o_id", "o_hash")
    sized = docs.select("d_id", "d_name", "d_hash", size("d_text").alias("n_words"))
    return sized.join(of, same, "left").select(
        "d_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def benchmark_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_id_col: str = "item_id", item_text_col: str = "text", max_index: int = MAX_INDEX) -> DataFrame:
    """``(id, n_words, n_hit, items)`` per row of ``docs``: words, words in windows of items, the items' ids as sorted strings.

    Null texts have no words and no hits; items without words have no window.
    Items of one id are one item; an item without an id is named ''.  Rows of
    ``docs`` with equal ids are documents of their own; extra columns are
    ignored.  An index of more than ``max_index`` words is not broadcast but joined;
    the rows are the same.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("d_id"), F.coalesce(F.col(text_col), F.lit("")).alias("d_text"))
    tests = (items.where(F.col(item_text_col).isNotNull())
             .select(F.coalesce(F.col(item_id_col).cast("string"), F.lit("")).alias("i_id"), F.col(item_text_col).alias("i_text")))
    # No text has more words than half its bytes, rounded up.
    size = tests.agg(F.sum((F.octet_length("i_text") + 1) / 2)).first()[0] or 0
    found = _looked_up(rows, tests) if size <= max_index else _joined(rows, tests)
    return found.select(F.col("d_id").alias(id_col), "n_words", "n_hit", "items")


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a word inside an item's window; rows of one id, or of none, go together."""
    bad = benchmark_hits(docs, items, id_col, text_col, **options).where("n_hit > 0").select(F.col(id_col).alias("b_id")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(F.col("b_id")), "left_anti")
