"""Embedding near-dedup with an inverted multi-index.

Unit vectors are cut into two halves, each with a codebook of its own (k-means
on a bounded sample); a pair of codes is a cell of the product grid.  A query
visits the cells in the order of a lower bound of the distance that any vector
in the cell must have from it, by a multi-sequence walk over the two sorted
code lists, up to a radius.  The radius is calibrated on the sample for a
target recall (1.0: the bound itself, which no link escapes).  Every vector
met is verified by its cosine in double precision.

Only vectors with the same label are compared.  Identical vectors are one
class with a weight, so a vector that a third of all rows share is one row
after a map-side aggregation.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from netbaseline.operators.sizing import is_small

from .common import stored
from .components import connected_components

SIMILARITY = 0.98
TARGET_RECALL = 0.9999
SAMPLE_ROWS = 20_000     # vectors that the codebooks and the radius are fitted on (smallest hashes of their ids)
CELL_ROWS = 400          # members of a label's cell aimed at
MAX_CODES = 256
BLOCK_ROWS = 4_096       # members and queries that meet in one group at most, about
MAX_BROADCAST = 200_000  # rows of some longs
ROUNDS = 12


def kmeans(points: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """Plain k-means; an emptied centre stays where it was."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(ROUNDS):
        code = distances(points, centres).argmin(1)
        for c in range(len(centres)):
            own = points[code == c]
            if len(own):
                centres[c] = own.mean(0)
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum(0, (points ** 2).sum(1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(1)[None])


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small components stay finite.
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows ** 2).sum(1, keepdims=True))


class Grid:
    """Two codebooks and the search radius."""

    def __init__(self, first: np.ndarray, second: np.ndarray, limit: float):
        self.books, self.limit, self.cut = (first, second), limit, first.shape[1]

    def halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return unit[:, :self.cut], unit[:, self.cut:]

    def codes(self, unit: np.ndarray) -> np.ndarray:
        a, b = (distances(h, c).argmin(1) for h, c in zip(self.halves(unit), self.books))
        return a * len(self.books[1]) + b

    def bounds(self, unit: np.ndarray) -> list[np.ndarray]:
        """Per half: squared distance that a vector coded c must have from the query, at least.

        It lies beyond the plane between c and the query's own centre.
        """
        out = []
        for half, centres in zip(self.halves(unit), self.books):
            if not half.shape[1]:
                out.append(np.zeros((len(unit), len(centres))))
                continue
            d = distances(half, centres)
            own = d.argmin(1)
            apart = np.sqrt(distances(centres, centres))[own]
            gap = np.maximum(0, d - d.min(1, keepdims=True)) / (2 * np.where(apart > 0, apart, np.inf))
            out.append(gap ** 2)
        return out

    def visits(self, unit: np.ndarray) -> list[list[int]]:
        """Cells per query, nearest first."""
        first, second = self.bounds(unit)
        width, out = second.shape[1], []
        for a, b in zip(first, second):
            rows, columns = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
            met = []
            for i in rows.tolist():
                if a[i] + b[columns[0]] > self.limit:
                    break
                for j in columns.tolist():
                    if a[i] + b[j] > self.limit:
                        break
                    met.append((a[i] + b[j], i * width + j))
            out.append([cell for _, cell in sorted(met)])
        return out


def fit_grid(sample: np.ndarray, codes: int, similarity: float, recall: float) -> Grid:
    """Codebooks and radius from unit vectors.

    The radius is the quantile ``recall`` of the bounds between vectors of the
    sample and partners at exactly the threshold, in random directions; at
    recall 1 it is the largest distance that linked vectors can have.
    """
    cut = (sample.shape[1] + 1) // 2
    books = [kmeans(h, codes) if h.shape[1] else np.zeros((1, 0)) for h in (sample[:, :cut], sample[:, cut:])]
    most = 2 - 2 * similarity + 1e-9
    grid = Grid(books[0], books[1], most)
    if recall < 1 and sample.shape[1] > 1:
        rng = np.random.default_rng(11)
        base = sample[rng.integers(0, len(sample), 20_000)]
        away = rng.standard_normal(base.shape)
        away -= (away * base).sum(1, keepdims=True) * base
        partner = similarity * base + math.sqrt(1 - similarity ** 2) * away / np.sqrt((away ** 2).sum(1, keepdims=True))
        first, second = grid.bounds(base)
        cell, width, at = grid.codes(partner), len(books[1]), np.arange(len(base))
        grid.limit = min(most, float(np.quantile(first[at, cell // width] + second[at, cell % width], recall)))
    return grid


def _matrix(vectors: pd.Series) -> np.ndarray:
    return _unit(np.array(vectors.tolist(), np.float64))


def _local_links(members: pd.DataFrame, queries: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Per query of one block: weight of the linked members, and the smallest node of its local component."""
    if not len(members) or not len(queries):
        return pd.DataFrame({"node": [], "weight": [], "top": []}).astype("int64")
    m, q = _matrix(members["x_vec"]), _matrix(queries["x_vec"])
    ids, weights, asked = members["x_rep"].to_numpy(), members["x_n"].to_numpy(), queries["x_rep"].to_numpy()
    top = {int(i): int(i) for i in ids}

    def find(i: int) -> int:
        while top.setdefault(i, i) != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    found = np.zeros(len(q), np.int64)
    for a in range(0, len(q), 512):
        near = q[a:a + 512] @ m.T >= similarity
        found[a:a + 512] = near @ weights
        for i, j in zip(*np.nonzero(near)):
            x, y = find(int(asked[a + i])), find(int(ids[j]))
            if x != y:
                top[max(x, y)] = min(x, y)
    nodes = np.concatenate([asked, ids[~np.isin(ids, asked)]])
    return pd.DataFrame({"node": nodes, "weight": np.concatenate([found, np.zeros(len(nodes) - len(found), np.int64)]),
                         "top": [find(int(i)) for i in nodes]})


def vector_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 similarity: float = SIMILARITY, recall: float = TARGET_RECALL) -> DataFrame:
    """``(id, n_links, component_id, kept)``, one row per vector.

    Null labels and vectors that are null, empty, zero or hold null or
    non-finite components link with nothing: 0 links, a component of their
    own.  Vectors of different lengths are not compared.  Rows with equal ids
    are vectors of their own: equal vectors of one label are a class, known by
    a 64-bit hash of both (among n classes about n^2 / 2^65 pairs collide).
    What leaves a block is one row per vector and
    block: a link count and the head of a local component, never a pair.
    """
    plain = F.transform(vector_col, lambda x: x + F.lit(0.0).cast("float"))     # -0.0 becomes 0.0
    fine = (F.col(label_col).isNotNull() & (F.size(vector_col) > 0) & F.exists(vector_col, lambda x: x != 0)
            & F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("x_id"), F.col(label_col).alias("x_label"),
                          F.when(F.coalesce(fine & F.col(id_col).isNotNull(), F.lit(False)), plain).alias("x_vec"))
    classes = stored(rows.where("x_vec is not null").groupBy("x_label", "x_vec")
                     .agg(F.min("x_id").alias("x_first"), F.count(F.lit(1)).alias("x_n"))
                     .withColumn("x_rep", F.xxhash64("x_label", "x_vec")).withColumn("x_dim", F.size("x_vec")), "vector-classes")
    results = None
    for dim, n, n_labels in classes.groupBy("x_dim").agg(F.count(F.lit(1)), F.countDistinct("x_label")).collect():
        of = _search(classes.where(F.col("x_dim") == dim).drop("x_dim", "x_first"), n, n_labels, similarity, recall)
        results = of if results is None else results.unionByName(of)
    if results is None:
        return rows.select(F.col("x_id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("x_id").alias("component_id"), F.lit(True).alias("kept"))
    results = stored(results, "vector-links")
    weights = results.groupBy(F.col("node").alias("r_rep")).agg(F.sum("weight").alias("r_weight"))
    parts = stored(connected_components(results.select(F.col("node").alias("a"), F.col("top").alias("b")), "vector-components"),
                   "vector-parts")
    # The smallest id of a component of several classes; a class by itself has its own.
    heads = (parts.join(classes.select("x_rep", "x_first"), F.col("node") == F.col("x_rep"))
             .groupBy("component").agg(F.min("x_first").alias("h_first")))
    tops = parts.join(heads, "component").select(F.col("node").alias("t_rep"), "h_first")
    per_class = (classes.select("x_rep", "x_first").join(weights, F.col("x_rep") == F.col("r_rep"))
                 .join(tops, F.col("x_rep") == F.col("t_rep"), "left")
                 .select("r_rep", (F.col("r_weight") - 1).alias("r_links"), F.coalesce("h_first", "x_first").alias("r_top")))
    keyed = rows.select("x_id", F.when(F.col("x_vec").isNotNull(), F.xxhash64("x_label", "x_vec")).alias("x_rep"))
    per_class = F.broadcast(per_class) if is_small(per_class, MAX_BROADCAST) else per_class
    out = keyed.join(per_class, F.col("x_rep") == F.col("r_rep"), "left")
    top = F.coalesce("r_top", "x_id")
    return out.select(F.col("x_id").alias(id_col), F.coalesce("r_links", F.lit(0)).cast("long").alias("n_links"),
                      top.alias("component_id"), F.coalesce(top == F.col("x_id"), F.lit(True)).alias("kept"))


def _search(classes: DataFrame, n: int, n_labels: int, similarity: float, recall: float) -> DataFrame:
    """``(node, weight, top)`` rows of all blocks, for classes of one length."""
    sample = classes.orderBy(F.xxhash64("x_rep"), "x_rep").limit(SAMPLE_ROWS).select("x_vec").toPandas()
    codes = int(min(MAX_CODES, max(1, round(math.sqrt(n / (CELL_ROWS * n_labels))))))
    grid = fit_grid(_matrix(sample["x_vec"]), codes, similarity, recall)

    @F.pandas_udf("cell: int, visits: array<int>")
    def place(vectors: pd.Series) -> pd.DataFrame:
        unit = _matrix(vectors)
        return pd.DataFrame({"cell": grid.codes(unit), "visits": grid.visits(unit)})

    placed = stored(classes.withColumn("x_at", place("x_vec")), "vector-cells")
    cell = F.col("x_at.cell").alias("x_cell")
    sizes = placed.groupBy("x_label", cell).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("x_blocks"))
    sizes = F.broadcast(sizes) if is_small(sizes, MAX_BROADCAST) else sizes
    block = F.pmod(F.xxhash64("x_rep"), F.col("x_blocks").cast("long")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("x_blocks") - 1))
    members = (placed.select("x_label", cell, "x_rep", "x_n", "x_vec").join(sizes, ["x_label", "x_cell"])
               .withColumn("x_m", block).withColumn("x_q", every))
    queries = (placed.select("x_label", F.explode("x_at.visits").alias("x_cell"), "x_rep", "x_vec")
               .join(sizes, ["x_label", "x_cell"]).withColumn("x_q", block).withColumn("x_m", every))
    keys = ["x_label", "x_cell", "x_m", "x_q"]
    columns = [*keys, "x_rep", "x_n", "x_vec"]
    met = members.select(*columns).unionByName(queries.withColumn("x_n", F.lit(0).cast("long")).select(*columns))

    def open_block(rows: pd.DataFrame) -> pd.DataFrame:
        return _local_links(rows[rows["x_n"] > 0], rows[rows["x_n"] == 0], similarity)

    return met.groupBy(*keys).applyInPandas(open_block, "node long, weight long, top long")
