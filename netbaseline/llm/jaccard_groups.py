"""N-gram Jaccard join with a token-group matrix.

1. Every document becomes the set of its distinct word shingles (64-bit
   hashes).  Documents with equal sets are one class.
2. Similar classes are put into groups: MinHash keys propose the smallest and
   the largest member of a key's bucket as partners, those that share half of
   their tokens are united, large groups are cut into blocks.  The members of
   a group are compared in one task, as a product of their 0/1 matrix.
3. The matrix token -> groups is built by a distributed count.  A document
   can only have a partner outside its group if a share of ``threshold`` of
   its tokens occurs in other groups; all others are done here.
4. For the documents left, the rarest of their shared tokens (as many as may
   be missing from a partner, and one) are looked up in the matrix; of every
   group they meet the overlap with the group's token union is counted; only
   groups that reach the bound are opened and their members verified.  Tokens
   that no other group has tighten the bound on both sides.

Steps 3 and 4 lose no link: a set Q and a member S of a group with union U
have |Q & S| <= |Q & U|, and similarity t needs |Q & S| >= t |Q|.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from netbaseline.operators.sizing import is_small

from .bpe import sub_batches
from .common import stored
from .components import connected_components

KEYS, ROWS = 8, 3
MAX_KNOWN_WORDS = 50_000     # remembered words per worker
MAX_BROADCAST = 1_000_000    # rows of two longs
BUCKET_TOKENS = 200_000      # tokens of one hash range of the matrix count, about
HELD_COUNTS = 500_000        # counts a task of it holds
PART_COUNTS = 4_096          # counts of a part of the documents that leave it together, about
PART_ROWS = 100_000          # documents of a part, about
GROUP_PERCENT = 50           # classes this similar are put into one group
GROUP_ROWS = 8_192           # members of a group and
GROUP_TOKENS = 1_000_000     # their tokens at most, about (larger ones are cut into blocks)
QUERY_ROWS = 4_096           # queries that open a group in one task, about
MATRIX = (256, 1_024)        # rows and columns of the 0/1 matrix that are multiplied at a time
FLUSH_TOKENS = 150_000       # tokens a map task holds before it packs them

_M = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_ALL = (1 << 64) - 1


class _Hashes(dict):
    """Word (bytes) -> 64-bit hash; a full table starts anew."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_KNOWN_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_known = _Hashes()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M[1]
    h = (h ^ (h >> np.uint64(27))) * _M[2]
    return h ^ (h >> np.uint64(31))


def _placed(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of words as the k-th of a shingle."""
    return _mix(h + np.uint64(k * int(_M[0]) & _ALL))


def token_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text (A-Z lower-cased; fewer words than ``width``: all as one)."""
    # bytes.lower and bytes.split know ASCII only: exactly A-Z and the blanks of the contract.
    lists = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    sizes = [len(w) for w in lists]
    h = np.fromiter((x for words in lists for x in map(_known.__getitem__, words)), np.uint64, sum(sizes))
    rolled = np.zeros(len(h), np.uint64)
    for k in range(min(width, len(h))):
        rolled[:len(h) - k] += _placed(h[k:], k)
    rolled = _mix(rolled)
    out, at = [], 0
    for n in sizes:
        if n >= width:
            out.append(np.unique(rolled[at:at + n - width + 1]))
        elif n:
            whole = sum(int(_placed(h[at + k:at + k + 1], k)[0]) for k in range(n)) + (n << 8)
            out.append(_mix(np.array([whole & _ALL], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def _sketch(width: int):
    odd = [np.uint64((int(_M[0]) * (2 * k + 1) ^ (k << 40)) & _ALL | 1) for k in range(KEYS * ROWS)]

    @F.pandas_udf("n long, f1 long, f2 long, keys array<long>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for batch in sub_batches(texts, 1 << 20):
            sets = token_sets(batch, width)
            full = [s for s in sets if len(s)]
            if full:
                flat = np.concatenate(full)
                starts = np.cumsum([0, *(len(s) for s in full)])[:-1]
                least = np.stack([np.minimum.reduceat(flat * c, starts) for c in odd], 1)
                keys = [[xxhash.xxh3_64_intdigest(bytes([b]) + row[b * ROWS:(b + 1) * ROWS].tobytes()) - (1 << 63)
                         for b in range(KEYS)] for row in least]
            made = iter(keys if full else ())
            for s in sets:
                f = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8")
                rows.append((len(s), int(f[0]), int(f[1]), next(made) if len(s) else []))
        return pd.DataFrame(rows, columns=["n", "f1", "f2", "keys"])

    return sketch


def _tokens(width: int):
    @F.pandas_udf("array<long>")
    def tokens(texts: pd.Series) -> pd.Series:
        return pd.Series([s.view(np.int64) for batch in sub_batches(texts, 1 << 20) for s in token_sets(batch, width)],
                         dtype=object)

    return tokens


def _common(a: str, b: str) -> Column:
    """Size of the intersection of two columns of distinct tokens."""
    @F.pandas_udf("long")
    def common(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(s, t, assume_unique=True)) for s, t in zip(x, y)], dtype="int64")

    return common(a, b)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if is_small(df, MAX_BROADCAST) else df


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of class representatives with 100 * common >= percent * union."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("w")).distinct(), "jaccard-wanted")
    texts = docs.join(_small(wanted), F.col("j_id") == F.col("w"), "left_semi")
    sets = stored(texts.groupBy("j_id").agg(F.min("j_text").alias("j_text"))
                  .select("j_id", _tokens(width)("j_text").alias("t")), "jaccard-sets")
    both = (pairs.join(sets.select(F.col("j_id").alias("a"), F.col("t").alias("ta")), "a")
            .join(sets.select(F.col("j_id").alias("b"), F.col("t").alias("tb")), "b"))
    low, high = F.least(F.size("ta"), F.size("tb")), F.greatest(F.size("ta"), F.size("tb"))
    counted = (both.where(100 * low >= percent * high)
               .select("a", "b", F.size("ta").alias("na"), F.size("tb").alias("nb"), _common("ta", "tb").alias("c")))
    return counted.where(f"100 * c >= {percent} * (na + nb - c)").select("a", "b")


def _seed_pairs(reps: DataFrame) -> DataFrame:
    members = reps.select("rep", F.explode("keys").alias("k"))
    buckets = stored(members.groupBy("k").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi"),
                     "jaccard-buckets")
    met = members.join(_small(buckets), "k")
    pairs = met.select(F.col("lo").alias("a"), F.col("rep").alias("b")).unionByName(
        met.select(F.col("rep").alias("a"), F.col("hi").alias("b")))
    return pairs.where("a <> b").distinct()


def _pack(width: int, buckets: int):
    """Tokens of (rep, grp, text) rows, packed per hash range; negative buckets: what is known to be shared.

    A token that two groups share within one pack is settled there: its
    documents are counted at once and a single entry goes on, so that a token
    of a third of all documents is one entry a pack.
    """
    span = np.uint64((1 << 64) // buckets + 1)

    def flush(reps: list[int], grps: list[int], sets: list[np.ndarray]) -> pd.DataFrame:
        tok = np.concatenate(sets)
        sizes = [len(s) for s in sets]
        rep, grp = np.repeat(np.array(reps, np.int64), sizes), np.repeat(np.array(grps, np.int64), sizes)
        order = np.argsort(tok, kind="stable")
        tok, rep, grp = tok[order], rep[order], grp[order]
        head = np.flatnonzero(np.r_[True, tok[1:] != tok[:-1]])
        run = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(tok)]))
        shared = (np.maximum.reduceat(grp, head) != np.minimum.reduceat(grp, head))[run]
        seen, n = np.unique(rep[shared], return_counts=True)
        # Counts need no partner: they go to one of as many groups, by any token of the pack.
        rows = [(-1 - int(tok[0]) % buckets, seen.tobytes(), n.astype(np.int64).tobytes(), b"")]
        go = ~shared
        go[head] = True                                  # one entry of a settled token goes on
        mark = np.where(shared, np.int64(-1), rep)[go]   # without a document to count
        tok, grp = tok[go], grp[go]
        at = np.searchsorted(tok // span, np.arange(buckets + 1).astype(np.uint64))
        for b in range(buckets):
            cut = slice(at[b], at[b + 1])
            if at[b] < at[b + 1]:
                by_doc = np.argsort(mark[cut], kind="stable")   # runs of one document compress well
                rows.append((b, tok[cut][by_doc].tobytes(), mark[cut][by_doc].tobytes(), grp[cut][by_doc].tobytes()))
        return pd.DataFrame(rows, columns=["bucket", "tok", "rep", "grp"])

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reps, grps, sets, held = [], [], [], 0
        for batch in batches:
            at = 0
            for texts in sub_batches(batch["j_text"], 1 << 18):
                for s in token_sets(texts, width):
                    if len(s):
                        reps.append(int(batch["rep"].iat[at]))
                        grps.append(int(batch["grp"].iat[at]))
                        sets.append(s)
                        held += len(s)
                    at += 1
                if held >= FLUSH_TOKENS:
                    yield flush(reps, grps, sets)
                    reps, grps, sets, held = [], [], [], 0
        if sets:
            yield flush(reps, grps, sets)

    return pack


def _range_counts(parts: list[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray]:
    """Of one hash range: documents, and how many of their tokens also occur in another group."""
    tok, rep, grp = (np.frombuffer(b"".join(x for part in parts for x in part[c]), kind)
                     for c, kind in (("tok", np.uint64), ("rep", np.int64), ("grp", np.int64)))
    order = np.argsort(tok, kind="stable")
    head = np.flatnonzero(np.r_[True, tok[order][1:] != tok[order][:-1]])
    run = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(tok)]))
    g = grp[order]
    settled = np.minimum.reduceat(rep[order], head) < 0
    shared = (settled | (np.maximum.reduceat(g, head) != np.minimum.reduceat(g, head)))[run]
    mine = rep[order][shared]
    return np.unique(mine[mine >= 0], return_counts=True)


def _summed(reps: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    rep, at = np.unique(np.concatenate(reps), return_inverse=True)
    return rep, np.bincount(at, np.concatenate(counts), minlength=len(rep)).astype(np.int64)


def _count_shared(parts: int):
    """Rows of :func:`_pack`, sorted by hash range -> (part, rep, n): counts per document, packed per part of the documents.

    One range comes at a time; counts are summed up to ``HELD_COUNTS`` of them (or ``PART_COUNTS`` a part).  A
    document has counts in nearly every task, so they leave it together:
    rows grow with the tokens and not with documents times tasks.  Rows of a
    negative bucket are such counts already.
    """
    room = max(HELD_COUNTS, parts * PART_COUNTS)

    def packed(reps: list[np.ndarray], counts: list[np.ndarray]) -> pd.DataFrame:
        rep, n = _summed(reps, counts)
        place = _mix(rep.astype(np.uint64)) % np.uint64(parts)
        order = np.argsort(place, kind="stable")
        rep, n, at = rep[order], n[order], np.searchsorted(place[order], np.arange(parts + 1).astype(np.uint64))
        return pd.DataFrame([(k, rep[at[k]:at[k + 1]].tobytes(), n[at[k]:at[k + 1]].tobytes())
                             for k in range(parts) if at[k] < at[k + 1]], columns=["part", "rep", "n"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reps, counts, held = [], [], 0
        rows_of: list[pd.DataFrame] = []

        def add(rep: np.ndarray, n: np.ndarray) -> None:
            nonlocal held
            reps.append(rep)
            counts.append(n)
            held += len(rep)

        for batch in batches:
            for bucket, rows in batch.groupby("bucket", sort=False):
                if rows_of and rows_of[0]["bucket"].iat[0] != bucket:
                    add(*_range_counts(rows_of))
                    rows_of = []
                if bucket < 0:
                    add(*(np.frombuffer(b"".join(rows[c]), np.int64) for c in ("tok", "rep")))
                else:
                    rows_of.append(rows)
                if held > room:
                    yield packed(reps, counts)
                    reps, counts, held = [], [], 0
        if rows_of:
            add(*_range_counts(rows_of))
        if held:
            yield packed(reps, counts)

    return count


def _sum_shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of :func:`_count_shared`, sorted by part -> (rep, shared), one part at a time."""
    part, reps, counts, held = None, [], [], 0
    for batch in batches:
        for k, rep, n in batch.itertuples(index=False):
            if k != part and reps:
                yield pd.DataFrame(dict(zip(("rep", "shared"), _summed(reps, counts))))
                reps, counts, held = [], [], 0
            part = k
            reps.append(np.frombuffer(rep, np.int64))
            counts.append(np.frombuffer(n, np.int64))
            held += len(reps[-1])
            if held > HELD_COUNTS:
                reps, counts = ([x] for x in _summed(reps, counts))
                held = len(reps[0])
    if reps:
        yield pd.DataFrame(dict(zip(("rep", "shared"), _summed(reps, counts))))


def _open_groups(left: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` across groups that step 4 leaves, for ``left(rep, grp, n)``.

    Let a document's own tokens be those in no other group, u of its n.  They
    are missing from every partner, so a link of Q and S needs
    n_Q - u_Q >= |Q & S| >= t (n_Q + u_S): a document with many own tokens can
    only have partners with very few.  Links are looked for from the end with
    fewer own tokens, which has u (1 + t) <= n (1 - t), and only in groups
    whose smallest and largest u allow it.
    """
    texts = docs.join(_small(left.select("rep", "grp", "n")), F.col("j_id") == F.col("rep"))
    tokens = stored(texts.groupBy("rep", "grp", "n").agg(F.min("j_text").alias("j_text"))
                    .select("rep", "grp", "n", F.explode(_tokens(width)("j_text")).alias("t")), "jaccard-tokens")
    spread = tokens.groupBy("t").agg(F.min("grp").alias("g0"), F.max("grp").alias("g1")).where("g0 <> g1").select("t")
    mine = (tokens.join(spread, "t")
            .withColumn("u", F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("rep")))
            .where(f"100 * (n - u) >= {percent} * n"))
    mine = stored(mine, "jaccard-shared")
    ranges = mine.groupBy("grp").agg(F.min("u").alias("u_min"), F.max("u").alias("u_max"))
    matrix = stored(mine.select("t", "grp").distinct().join(ranges, "grp").withColumnRenamed("grp", "other"),
                    "jaccard-matrix")
    groups = matrix.groupBy("t").agg(F.count(F.lit(1)).alias("groups"))
    asked = mine.where(f"{100 + percent} * u <= {100 - percent} * n").join(groups, "t").withColumn(
        "need", F.ceil(F.lit(percent) * (F.col("n") + F.col("u")) / 100))
    rarest = F.row_number().over(Window.partitionBy("rep").orderBy("groups", "t"))
    probes = (asked.withColumn("place", rarest).where("groups > 1 and place <= n - u - need + 1")
              .select("rep", "grp", "n", "u", "t"))
    meets = matrix.select(F.col("t").alias("m_t"), "other", "u_min", "u_max")
    fits = f"grp <> other and u_max >= u and {percent} * greatest(u_min, u) + 100 * u <= {100 - percent} * n"
    met = (probes.join(meets, (F.col("t") == F.col("m_t")) & F.expr(fits))
           .select("rep", "n", "u", "other", "u_min").distinct())
    reach = stored(met.join(asked.select("rep", "t"), "rep").join(matrix.select("t", "other"), ["t", "other"])
                   .groupBy("rep", "n", "u", "other", "u_min").agg(F.count(F.lit(1)).alias("c"))
                   .where(f"100 * c >= {percent} * (n + greatest(u_min, u))")
                   .select("rep", F.col("other").alias("grp")), "jaccard-reach")
    # Members and queries of an opened group meet in one task; many queries are dealt over several.
    chunks = reach.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("chunks"))
    inside = (mine.select("rep", "grp").distinct().join(chunks, "grp")
              .select("rep", "grp", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")))
    queries = (reach.join(chunks, "grp")
               .select("rep", "grp", F.lit(True).alias("asks"), F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int").alias("chunk")))
    return _links_in_groups(inside.unionByName(queries), docs, width, percent)


def _links_in_groups(placed: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` that connect what is linked within each ``(grp, chunk)`` of ``placed(rep, grp, asks, chunk)``.

    Without queries all members are compared, else the queries with the
    members.  Only a spanning forest of the links leaves the task.
    """
    wanted = stored(placed.select("rep").distinct(), "jaccard-members")
    texts = docs.join(_small(wanted.withColumnRenamed("rep", "w")), F.col("j_id") == F.col("w"), "left_semi")
    sets = stored(texts.groupBy("j_id").agg(F.min("j_text").alias("j_text"))
                  .select("j_id", _tokens(width)("j_text").alias("t")), "jaccard-member-sets")

    def open_group(rows: pd.DataFrame) -> pd.DataFrame:
        return _spanning_links(rows["rep"].to_numpy(), list(rows["t"]), rows["asks"].to_numpy(bool), percent)

    return (placed.join(sets, F.col("rep") == F.col("j_id")).select("rep", "grp", "asks", "chunk", "t")
            .groupBy("grp", "chunk").applyInPandas(open_group, "a long, b long"))


def _spanning_links(reps: np.ndarray, sets: list[np.ndarray], asks: np.ndarray, percent: int) -> pd.DataFrame:
    """Spanning forest of the links among some sets: a 0/1 matrix of the shared tokens times its transpose."""
    members = np.flatnonzero(~asks)
    left = np.flatnonzero(asks) if asks.any() else members
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    tokens, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    seen = times[at] > 1
    owner, at = owner[seen], column[at[seen]]
    top = {int(r): int(r) for r in reps}

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    edges, width = [], max(1, int(column[-1]) + 1 if len(column) else 1)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for lo in range(0, len(left), MATRIX[0]):
        rows = left[lo:lo + MATRIX[0]]
        common = np.zeros((len(rows), len(members)), np.float32)
        place_l, place_m = np.full(len(sets), -1), np.full(len(sets), -1)
        place_l[rows], place_m[members] = np.arange(len(rows)), np.arange(len(members))
        for first in range(0, width, MATRIX[1]):
            cut = slice(*np.searchsorted(at, (first, first + MATRIX[1])))
            x, y = (np.zeros((k, MATRIX[1]), np.float32) for k in (len(rows), len(members)))
            for matrix, place in ((x, place_l), (y, place_m)):
                mine = place[owner[cut]]
                matrix[mine[mine >= 0], at[cut][mine >= 0] - first] = 1
            common += x @ y.T
        total = sizes[rows][:, None] + sizes[members][None] - common
        for i, j in zip(*np.nonzero((100 * common >= percent * total) & (common > 0))):
            p, q = int(reps[rows[i]]), int(reps[members[j]])
            a, b = find(p), find(q)
            if a != b:
                top[max(a, b)] = min(a, b)
                edges.append((p, q))
    return pd.DataFrame(edges, columns=["a", "b"]).astype("int64")


def _groups(reps: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``(rep, grp, n)``: classes that MinHash proposes and that share half of their tokens, in blocks of bounded size."""
    similar = _verified(stored(_seed_pairs(reps), "jaccard-seeds"), docs, width, min(percent, GROUP_PERCENT))
    parts = connected_components(similar, "jaccard-groups")
    blocks = (parts.join(reps.select(F.col("rep").alias("node"), "n"), "node").groupBy("component")
              .agg(F.ceil(F.greatest(F.count(F.lit(1)) / GROUP_ROWS, F.sum("n") / GROUP_TOKENS)).cast("int").alias("blocks")))
    cut = parts.join(_small(blocks), "component").select(
        F.col("node").alias("g_rep"),
        F.when(F.col("blocks") == 1, F.col("component")).otherwise(
            F.xxhash64("component", F.pmod(F.xxhash64("node"), F.col("blocks")))).alias("g"))
    return (reps.select("rep", "n").join(cut, F.col("rep") == F.col("g_rep"), "left")
            .select("rep", F.coalesce("g", "rep").alias("grp"), "n"))


def _one_text(docs: DataFrame) -> DataFrame:
    """Rows of an id that comes several times get the smallest of its texts."""
    several = docs.where("j_id is not null").groupBy("j_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    if several.isEmpty():
        return docs
    least = (docs.join(several, "j_id", "left_semi").groupBy(F.col("j_id").alias("s_id"))
             .agg(F.min("j_text").alias("s_text"), F.lit(True).alias("s_hit")))
    return (docs.join(least, F.col("j_id") == F.col("s_id"), "left")
            .select("j_id", F.when(F.col("s_hit"), F.col("s_text")).otherwise(F.col("j_text")).alias("j_text")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                       percent: int = 90) -> DataFrame:
    """``(id, n_shingles, component_id)``, one row per document.

    Two documents link when 100 * common >= percent * union; component_id is
    the smallest id reachable by links.  Null texts and texts without words
    have an empty set and link with nothing.  Of rows with
    equal ids the smallest text stands for all.  Rows without an id take no
    part (component null).
    """
    docs = _one_text(docs.select(F.col(id_col).cast("long").alias("j_id"), F.col(text_col).alias("j_text")))
    sets = stored(docs.withColumn("s", _sketch(width)("j_text")).select("j_id", "s.*"), "jaccard-sketches")
    full = sets.where("n > 0 and j_id is not null")
    classes = stored(full.groupBy("n", "f1", "f2").agg(
        F.min("j_id").alias("rep"), F.max("j_id").alias("last")), "jaccard-classes")
    named = docs.where("j_id is not null")
    reps = full.join(classes.select(F.col("rep").alias("j_id"), "rep", F.col("f1").alias("g1"), F.col("f2").alias("g2")),
                     "j_id").where("f1 = g1 and f2 = g2").select("rep", "n", "keys").dropDuplicates(["rep", "n"])
    reps = stored(reps, "jaccard-reps")
    grouped = stored(_groups(reps, named, width, percent), "jaccard-grouped")
    several = grouped.groupBy("grp").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("grp")
    inside = grouped.join(_small(several), "grp").select("rep", "grp", F.lit(False).alias("asks"), F.lit(0).alias("chunk"))
    links = _links_in_groups(inside, named, width, percent)
    total, documents = grouped.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    buckets = int(max(32, total // BUCKET_TOKENS))
    width_of_shuffle = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = int(max(width_of_shuffle, documents // PART_ROWS))
    packed = (named.join(_small(grouped.select("rep", "grp")), F.col("j_id") == F.col("rep")).select("rep", "grp", "j_text")
              .mapInPandas(_pack(width, buckets), "bucket int, tok binary, rep binary, grp binary"))
    # Ranges are dealt over the session's shuffle partitions and come one after the other in each.
    dealt = packed.repartition(width_of_shuffle, "bucket").sortWithinPartitions("bucket")
    counted = dealt.mapInPandas(_count_shared(parts), "part int, rep binary, n binary")
    shared = (counted.repartition(width_of_shuffle, "part").sortWithinPartitions("part")
              .mapInPandas(_sum_shared, "rep long, shared long"))
    left = stored(grouped.join(shared, "rep").where(f"100 * shared >= {percent} * n").select("rep", "grp", "n"),
                  "jaccard-left")
    edges = links.unionByName(_open_groups(left, named, width, percent))
    parts = connected_components(edges, "jaccard-components")
    # Copies point to the smallest id of their class; only classes of two and more need a look-up.
    copies = classes.where("last <> rep").select(F.col("n").alias("cn"), F.col("f1").alias("c1"), F.col("f2").alias("c2"),
                                                 F.col("rep").alias("c_rep"))
    mapped = (sets.join(_small(copies), (F.col("n") == F.col("cn")) & (F.col("f1") == F.col("c1"))
                        & (F.col("f2") == F.col("c2")), "left")
              .select("j_id", "n", F.coalesce(F.when(F.col("n") > 0, F.col("c_rep")), F.col("j_id")).alias("rep")))
    out = mapped.join(_small(parts), F.col("rep") == F.col("node"), "left")
    return out.select(F.col("j_id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("j_id").isNotNull(), F.coalesce("component", "rep")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; rows without an id stay."""
    parts = jaccard_components(docs, id_col, text_col, width, percent)
    keep = parts.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).cast("long").alias("k_id")).distinct()
    # The row travels as one column, so that no column of it can clash.
    rows = docs.select(F.struct(*docs.columns).alias("k_row"), F.col(id_col).cast("long").alias("k_own"))
    kept = rows.join(keep, F.col("k_own") == F.col("k_id"), "left_semi").select("k_row.*")
    return kept.unionByName(docs.where(F.col(id_col).isNull()))
