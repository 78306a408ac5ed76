"""Vector code compression: product codebooks by Lloyd's rounds over cover trees.

Vectors become integers (floor of ``scale`` times each component) and are cut
into ``parts`` consecutive parts, each with a codebook of its own.

1. Every block of up to ``BLOCK`` vectors of a task gets one cover tree per
   part over its distinct parts: a node at scale s covers its points within s,
   its children lie more than s / 2 apart and cover them within s / 2.  The
   points of a node are neighbours in the tree's order, so cumulative sums
   give any subtree's sum and count.  The trees are written once.
2. In every round a node whose centre is so much nearer to one entry than to
   all others that its radius can't change that (triangle inequality) gives
   its whole subtree to that entry; other nodes go down with the entries that
   are left, and what is undecided at a leaf is compared exactly in integers.
3. Tasks return one sum per part and entry; the new entries are their floors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from netbaseline.operators.sizing import is_small

from .common import stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BLOCK = 4096             # vectors of one block (one tree per part)
LEAF = 16                # points of a node that are compared without further children
TREE_ROWS = 8            # blocks in one Arrow batch: a block takes some megabytes
MAX_BROADCAST = 200_000  # rows of a label and a sum


class CoverTree:
    """Points in tree order, their cumulative sums, and the nodes, parents before children."""

    def __init__(self, points: np.ndarray, weight: np.ndarray, lo: np.ndarray, hi: np.ndarray, first: np.ndarray,
                 kids: np.ndarray, radius: np.ndarray, place: np.ndarray):
        self.points, self.weight, self.lo, self.hi = points, weight, lo, hi
        self.first, self.kids, self.radius, self.place = first, kids, radius, place   # place: row -> point
        self.sums = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(points * weight[:, None], axis=0, out=self.sums[1:])
        self.counts = np.r_[0, np.cumsum(weight)]

    @classmethod
    def of(cls, rows: np.ndarray) -> "CoverTree":
        """The tree over the distinct rows of an integer matrix."""
        distinct, place, weight = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        order, nodes, radius = _grow(distinct.astype(np.float64))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return cls(distinct[order], weight[order], *nodes, radius, back[place.ravel()])

    def pack(self) -> bytes:
        whole = [np.array([*self.points.shape, len(self.lo), len(self.place)]), self.points.ravel(), self.weight,
                 self.lo, self.hi, self.first, self.kids, self.place]
        return np.concatenate(whole).astype(np.int32).tobytes() + self.radius.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> "CoverTree":
        m, width, nodes, rows = np.frombuffer(data, np.int32, 4).tolist()
        whole = np.frombuffer(data, np.int32, 4 + m * width + m + 4 * nodes + rows)[4:].astype(np.int64)
        points, weight, lo, hi, first, kids, place = np.split(
            whole, np.cumsum([m * width, m, nodes, nodes, nodes, nodes]))
        radius = np.frombuffer(data[len(data) - 8 * nodes:], np.float64)
        return cls(points.reshape(m, width), weight, lo, hi, first, kids, radius, place)

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per entry of ``book`` the sum and count of its points, and the entry of every point in tree order."""
        sums, counts = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
        code = np.zeros(len(self.points), np.int64)
        _, entries = np.unique(book, axis=0, return_index=True)
        entries = np.sort(entries)                       # of equal entries the lowest index takes all
        centres = book[entries].astype(np.float64)
        nodes, may = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
        while len(nodes):
            lo, hi = self.lo[nodes], self.hi[nodes]
            away = np.sqrt(((self.points[lo][:, None].astype(np.float64) - centres[None]) ** 2).sum(2))
            away[~may] = np.inf
            best, reach = away.min(1), self.radius[nodes]
            # Rounding of the distances is some 1e-15 of them; the slack only sends more nodes down.
            may &= away <= (best + 2 * reach + 1e-9 * (1 + best + reach))[:, None]
            whole = may.sum(1) == 1
            if whole.any():
                to = entries[may[whole].argmax(1)]
                a, b = lo[whole], hi[whole]
                np.add.at(sums, to, self.sums[b] - self.sums[a])
                np.add.at(counts, to, self.counts[b] - self.counts[a])
                code[_ranges(a, b)] = np.repeat(to, b - a)
            leaf = ~whole & (self.kids[nodes] == 0)
            if leaf.any():
                a, b = lo[leaf], hi[leaf]
                at = _ranges(a, b)
                apart = ((self.points[at][:, None] - book[entries][None]) ** 2).sum(2)
                apart[~np.repeat(may[leaf], b - a, axis=0)] = np.iinfo(np.int64).max
                to = entries[apart.argmin(1)]            # the first of equals: the lower index
                np.add.at(sums, to, self.points[at] * self.weight[at][:, None])
                np.add.at(counts, to, self.weight[at])
                code[at] = to
            down = ~whole & ~leaf
            kids = self.kids[nodes[down]]
            nodes, may = _ranges(self.first[nodes[down]], self.first[nodes[down]] + kids), np.repeat(may[down], kids, axis=0)
        return sums, counts, code


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [lo, hi), one range after the other."""
    n = hi - lo
    return np.arange(n.sum()) + np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) if len(n) else np.zeros(0, np.int64)


def _grow(x: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...], np.ndarray]:
    """Order of the points, (lo, hi, first child, children) of the nodes and their radii; a node's centre is its first point.

    All nodes of a level are split side by side: in every step each takes its
    first point that no child covers yet as the centre of another child.
    """
    order = np.arange(len(x))
    lo, hi = np.array([0]), np.array([len(x)])
    radius = np.array([np.sqrt(((x - x[0]) ** 2).sum(1)).max()])
    levels, total = [], 1
    while len(lo):
        split = (hi - lo > LEAF) & (radius > 0)
        n = hi[split] - lo[split]
        at, own = _ranges(lo[split], hi[split]), np.repeat(np.arange(len(n)), n)
        points, scale = x[order[at]], 2.0 ** (np.ceil(np.log2(radius[split])) - 1)
        child, gap, step = np.zeros(len(at), np.int64), np.zeros(len(at)), 0
        left = np.arange(len(at))
        while len(left):
            heads = np.flatnonzero(np.r_[True, own[left][1:] != own[left][:-1]])
            centre = points[np.repeat(left[heads], np.diff(np.r_[heads, len(left)]))]
            d = np.sqrt(((points[left] - centre) ** 2).sum(1))
            near = d <= scale[own[left]]
            child[left[near]], gap[left[near]] = step, d[near]
            left, step = left[~near], step + 1
        by = np.lexsort((child, own))
        order[at] = order[at][by]
        starts = np.flatnonzero(np.r_[True, (own[by][1:] != own[by][:-1]) | (child[by][1:] != child[by][:-1])][:len(at)])
        kids, first = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        kids[split] = np.bincount(own[by][starts], minlength=len(n))
        first[split] = total + np.r_[0, np.cumsum(kids[split])[:-1]][:len(n)]
        levels.append((lo, hi, first, kids, radius))
        total += len(starts)
        lo, hi = at[starts], at[np.r_[starts[1:], len(at)] - 1] + 1 if len(at) else at
        radius = np.maximum.reduceat(gap[by], starts) if len(at) else gap
    nodes = tuple(np.concatenate([level[k] for level in levels]) for k in range(4))
    return order, nodes, np.concatenate([level[4] for level in levels])


def _cuts(width: int, parts: int) -> list[int]:
    """Borders of the parts; equal where ``parts`` divides the width."""
    return [k * width // parts for k in range(parts + 1)]


def _blocks(width: int, parts: int, schema: pa.Schema):
    """Rows (id, label, v) -> one row per block: ids, labels and the trees of its parts."""
    cuts = _cuts(width, parts)

    def block(table: pa.Table) -> pa.RecordBatch:
        n = len(table)
        v = np.concatenate([np.asarray(c.flatten()) for c in table["v"].chunks]).reshape(n, width)
        trees = [CoverTree.of(v[:, a:b]).pack() for a, b in zip(cuts, cuts[1:])]
        one = [pa.ListArray.from_arrays([0, n], table[c].combine_chunks()) for c in ("id", "label")]
        return pa.RecordBatch.from_arrays([*one, pa.array([trees], schema.field("trees").type)], schema=schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            while n >= BLOCK:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, BLOCK))
                held, n = table.slice(BLOCK).to_batches(), n - BLOCK
        if n:
            yield block(pa.Table.from_batches(held))

    return build


def _totals(books: list[np.ndarray], schema: pa.Schema):
    """Trees -> (part, entry, dim, total) of a task; the count of an entry is its row of dim -1."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = [np.zeros(b.shape, np.int64) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for trees in batch.column("trees"):
                for p, data in enumerate(trees):
                    s, n, _ = CoverTree.unpack(data.as_py()).assign(books[p])
                    sums[p] += s
                    counts[p] += n
        rows = [(p, e, d, int(x)) for p in range(len(books)) for e in np.flatnonzero(counts[p]).tolist()
                for d, x in enumerate([counts[p][e], *sums[p][e]], -1)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, schema.types)],
                                         schema=schema)

    return count


def _codes(books: list[np.ndarray], schema: pa.Schema):
    """Trees -> (id, label, code, error) per vector."""
    names = np.array([f"{e:02x}" for e in range(max(len(b) for b in books))])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, trees in enumerate(batch.column("trees")):
                text, error = None, 0
                for p, data in enumerate(trees):
                    tree = CoverTree.unpack(data.as_py())
                    _, _, to = tree.assign(books[p])
                    apart = ((tree.points - books[p][to]) ** 2).sum(1)
                    error = error + apart[tree.place]
                    mine = names[to[tree.place]]
                    text = mine if text is None else np.char.add(text, mine)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[k].values, batch.column("labels")[k].values,
                     pa.array(text.tolist(), pa.string()), pa.array(error, pa.int64())], schema=schema)

    return code


@contextmanager
def _tree_batches(spark: SparkSession):
    """Few blocks per Arrow batch, while a job over the trees runs."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(TREE_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _refined(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: as many sums as the codebooks have components reach the driver."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("dim", pa.int32()), ("total", pa.int64())])
    sums = (trees.select("trees").mapInArrow(_totals(books, schema), "part int, entry int, dim int, total long")
            .groupBy("part", "entry", "dim").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).collect())
    of = {(r["part"], r["entry"], r["dim"]): int(r["total"]) for r in sums}
    new = [b.copy() for b in books]
    for (p, e, d), total in of.items():
        if d >= 0:
            new[p][e, d] = total // of[p, e, -1]
    return new


def encode_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``(id, code, error, label_error, codebooks_sha256)`` per row whose vector has finite components only.

    Rows with a null vector, or null or non-finite components, are dropped.
    The codebooks start from the ``entries`` smallest ids (null ids last, equal
    ids by vector); at most 256.  Where ``parts`` does not divide the length,
    parts differ by one component.  Vectors whose length is not that of the
    first of these, and those with components beyond what a squared distance
    in 64 bits allows, stay with code and error null.  ``label_error`` sums
    the errors of equal labels, nulls together (null beyond 64 bits).  Rows
    with equal ids are vectors of their own; extra columns are ignored.
    Sums, counts and comparisons are exact integers.
    """
    spark = vectors.sparkSession
    fine = F.col(vector_col).isNotNull() & F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = (vectors.where(fine).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("v")))
    seeds = rows.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    width = len(seeds[0]["v"]) if seeds else 0
    most = math.isqrt((2 ** 63 - 1) // max(1, width)) // 2
    usable = (F.size("v") == width) & F.forall("v", lambda x: (x <= most) & (x >= -most))
    label_type = rows.schema["label"].dataType.simpleString()
    first = [r["v"] for r in seeds if len(r["v"]) == width and all(abs(x) <= most for x in r["v"])]
    matrix = np.array(first, np.int64).reshape(len(first), width)
    cuts = _cuts(width, parts)
    books = [matrix[:, a:b].copy() for a, b in zip(cuts, cuts[1:])]
    odd = rows if not len(matrix) else rows.where(~usable)
    coded = odd.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if len(matrix):
        kind = pa.schema([("label", _arrow_type(rows, "label"))]).field("label").type
        blocks = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(kind)), ("trees", pa.list_(pa.binary()))])
        trees = stored(rows.where(usable).mapInArrow(
            _blocks(width, parts, blocks), f"ids array<long>, labels array<{label_type}>, trees array<binary>"), "vector-trees")
        one = pa.schema([("id", pa.int64()), ("label", kind), ("code", pa.string()), ("error", pa.int64())])
        with _tree_batches(spark):
            for _ in range(rounds):
                books = _refined(trees, books)
            coded = stored(trees.mapInArrow(_codes(books, one), f"id long, label {label_type}, code string, error long")
                           .unionByName(coded), "vector-codes")
    per = (coded.groupBy(F.col("label").alias("l"))
           .agg(F.sum(F.col("error").cast("decimal(20,0)")).alias("s"))
           .select("l", F.col("s").try_cast("long").alias("label_error")))
    per = F.broadcast(per) if is_small(per, MAX_BROADCAST) else per
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    return (coded.join(per, F.col("label").eqNullSafe(F.col("l")), "left")
            .select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    """The Arrow type of a column."""
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[name].dataType)
