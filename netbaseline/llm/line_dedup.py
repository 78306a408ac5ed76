"""Fuzzy line dedup by MinHash, in DataFrame functions only.

1. Lines (trimmed, lower case, not blank) are known by a 64-bit hash.  Those
   shorter than a shingle have no signature: they are repeats only of equal lines.
2. Character shingles: all windows of ``SHINGLE`` bytes of the UTF-8 text.
   The signature is taken from all of them in every line, whatever its
   length: ``BANDS`` x ``ROWS`` minima of hash XOR seed, each band with a hash
   of its own.  Lines of similarity 0.8 share a band with probability 0.986,
   0.9: 0.9996.  Equal lines are one from here on.
3. In every band bucket the lines are linked to two of its lines first: the
   most frequent one and the first in an order of the bucket's own, so that
   groups of copies need links by the number of lines and not by the square of
   a bucket.  Bitmaps of the shingles rule out pairs, but only such as can not
   have the similarity; every link is verified by the exact Jaccard similarity
   of all shingles.
4. Distributed union-find.  In buckets that still hold several components the
   lines outside the largest one meet all lines of the others, in blocks of
   ``BLOCK`` times ``BLOCK`` lines, ruled out by bitmaps twice, the second time by
   wider ones, and verified the same way.  If there are more such pairs than lines in buckets, of a line and a component the
   likeliest pair is verified first and the others only if it is no link.
5. Union-find with these links too; of every component the earliest line stays.

Among n distinct lines about n^2 / 2^65 pairs of hashes collide (none to be
expected below 10^9 lines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from netbaseline.operators.sizing import is_small

from .common import stored
from .components import connected_components

MIN_BYTES = 1                    # blank lines take no part
SHINGLE = 8
BANDS, ROWS = 6, 3
AT_ONCE = 4                      # shingles that one row of an aggregate stands for
BLOCK = 2048                     # lines of a bucket that meet as many others in one group of a join
BITMAP = 32                      # longs of a line's shingle bitmap
WIDE_BITMAP = 128                # and of the second one, of lines that would meet many others
SIMILARITY = 0.8
LAST = (1 << 63) - 1             # rank of a document without an id
MAX_BROADCAST = 500_000          # rows of two or three longs
_LINE_BASE = 1 << 32             # rank = document's key * base + line number
_TEXT_BASE = 1 << 31             # document's key = id * base + bits of the text's hash


def document_key(id_col: Column, text: Column) -> Column:
    """The order of documents: by id (none: last), and by a hash of the text where ids repeat or lack."""
    sub = F.pmod(F.xxhash64(text), F.lit(_TEXT_BASE)).cast("decimal(10,0)")
    return (F.coalesce(id_col.cast("long"), F.lit(LAST)).cast("decimal(19,0)") * F.lit(_TEXT_BASE).cast("decimal(10,0)")
            + sub).cast("decimal(29,0)")


def _normal(line: Column) -> Column:
    """Trimmed and in lower case; btrim looks at every character, so only lines with a blank end meet it."""
    raw = line.cast("binary")
    blank = [F.substring(raw, at, 1).isin(*(F.lit(c) for c in (b" ", b"\t", b"\r"))) for at in (1, -1)]
    return F.lower(F.when(blank[0] | blank[1], F.btrim(line, F.lit(" \t\r"))).otherwise(line))


def _lines(rows: DataFrame) -> DataFrame:
    """``(d, norm, rank)`` of every line that takes part."""
    split = rows.where("l_text is not null").select("l_key", F.posexplode(F.split("l_text", "\n")).alias("pos", "line"))
    rank = (F.col("l_key") * F.lit(_LINE_BASE).cast("decimal(10,0)")).cast("decimal(38,0)") + F.col("pos")
    return (split.withColumn("norm", _normal(F.col("line"))).where(F.octet_length("norm") >= MIN_BYTES)
            .select(F.xxhash64("norm").alias("d"), "norm", rank.cast("decimal(38,0)").alias("rank")))


def _seeds(n: int) -> list[int]:
    """Fixed 32-bit seeds, by multiplicative hashing of 1..n."""
    return [((k * 0x9E3779B1) & 0xFFFFFFFF) - (1 << 31) for k in range(1, n + 1)]


def _spread(lines: DataFrame) -> DataFrame:
    """``lines(d, b)`` -> ``(d, p, n, h0, h1 ...)``: hashes of ``AT_ONCE`` shingles in a row, from the ``p``-th of ``n`` on.

    A row that the shingles do not fill repeats the last one.  A line without a shingle has one row, ``p`` null.
    """
    step = f"if(n > 0, sequence(1, n, {AT_ONCE}), null)"
    rows = lines.select("d", "b", F.expr(f"greatest(octet_length(b) - {SHINGLE - 1}, 0)").alias("n"))
    return rows.select("d", "b", "n", F.explode_outer(F.expr(step)).alias("p")).select(
        "d", "p", "n", *(F.expr(f"hash(substring(b, least(p + {i}, n), {SHINGLE}))").alias(f"h{i}") for i in range(AT_ONCE)))


def signatures(lines: DataFrame) -> DataFrame:
    """``(d, f, n, minima)`` per distinct line: occurrences, number of shingles, signature.

    Shingles are made and reduced in the task that reads the line; neither they
    nor the text travel.  A line shorter than a shingle has ``n`` 0 and no part
    in the buckets.
    """
    spread = _spread(lines.select("d", F.col("norm").cast("binary").alias("b")))
    spread = spread.select("d", "p", "n", *(F.expr(f"hash(h{i}, {b})").alias(f"h{i}_{b}") for i in range(AT_ONCE) for b in range(BANDS)))
    minima = [F.min(F.expr(f"least({', '.join(f'h{i}_{k // ROWS} ^ int({s})' for i in range(AT_ONCE))})")).alias(f"m{k}")
              for k, s in enumerate(_seeds(BANDS * ROWS))]
    reduced = spread.groupBy("d").agg(F.count(F.expr("if(coalesce(p, 1) = 1, 1, null)")).alias("f"), F.max("n").cast("long").alias("n"), *minima)
    return reduced.select("d", "f", "n", F.array(*(F.col(f"m{k}") for k in range(BANDS * ROWS))).alias("minima"))


def _band_keys() -> Column:
    """One key per band of the signature."""
    return F.array(*(F.xxhash64(F.lit(b), *(F.get("minima", b * ROWS + r) for r in range(ROWS))) for b in range(BANDS)))


def _members(marks: DataFrame) -> DataFrame:
    return marks.where("n > 0").select("d", "f", F.explode(_band_keys()).alias("k"))


def band_buckets(marks: DataFrame) -> DataFrame:
    """``(k, n, top, lo)`` of the buckets of two lines and more: the number of lines and the two that all others meet."""
    often = F.expr(f"least(f, {1 << 20}) * {1 << 40} + (xxhash64(d) & {(1 << 40) - 1})")
    return (_members(marks).groupBy("k")
            .agg(F.count(F.lit(1)).alias("n"), F.max_by("d", often).alias("top"), F.min_by("d", F.xxhash64("d", "k")).alias("lo"))
            .where("n > 1"))


def _with_buckets(marks: DataFrame, buckets: DataFrame) -> DataFrame:
    return _members(marks).join(F.broadcast(buckets) if is_small(buckets, MAX_BROADCAST) else buckets, "k")


def candidate_pairs(marks: DataFrame, buckets: DataFrame) -> DataFrame:
    """``(a, b)``: the lines of every band bucket with the two lines that stand for it."""
    met = _with_buckets(marks, buckets).select("d", F.explode(F.array("top", "lo")).alias("e")).where("d <> e")
    return met.select(F.least("d", "e").alias("a"), F.greatest("d", "e").alias("b")).distinct()


def _shingles(raw: str) -> Column:
    """All shingles of a binary column as 64-bit hashes, in order, repeats included."""
    return F.expr(f"transform(sequence(1, octet_length({raw}) - {SHINGLE - 1}), p -> xxhash64(substring({raw}, p, {SHINGLE})))")


def _texts(wanted: DataFrame, lines: DataFrame) -> DataFrame:
    """``(d, t)``: the normalised text of the lines ``wanted(w)``."""
    side = F.broadcast(wanted) if is_small(wanted, MAX_BROADCAST) else wanted
    return lines.select("d", "norm").join(side, F.col("d") == F.col("w"), "left_semi").groupBy("d").agg(F.first("norm").alias("t"))


def bitmaps(texts: DataFrame, longs: int = BITMAP) -> DataFrame:
    """``(d, n, bits)`` of ``texts(d, t)``: shingles, repeats included, and their bitmap."""
    spread = _spread(texts.select("d", F.col("t").cast("binary").alias("b"))).where("n > 0").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(longs // BITMAP - 1))))
    spread = spread.select("d", "n", "part", *(c for i in range(AT_ONCE) for c in (
        F.expr(f"(shiftright(h{i}, 6) & {longs - 1}) - part * {BITMAP}").alias(f"at{i}"), F.expr(f"shiftleft(1L, h{i} & 63)").alias(f"bit{i}"))))
    bits = [F.bit_or(F.expr(" | ".join(f"if(at{i} = {k}, bit{i}, 0L)" for i in range(AT_ONCE)))).alias(f"b{k}") for k in range(BITMAP)]
    parts = spread.groupBy("d", "part").agg(F.max("n").alias("n"), *bits).select(
        "d", "part", F.col("n").cast("long").alias("n"), F.array(*(F.col(f"b{k}") for k in range(BITMAP))).alias("bits"))
    if longs == BITMAP:
        return parts.drop("part")
    whole = parts.groupBy("d").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("part", "bits"))).alias("parts"))
    return whole.select("d", "n", F.flatten(F.col("parts.bits")).alias("bits"))


def _differ(a: str, b: str) -> Column:
    """Bits that differ: every one stands for another shingle that only one of the lines has."""
    return sum((F.bit_count(F.get(f"bits{a}", k).bitwiseXOR(F.get(f"bits{b}", k))) for k in range(BITMAP)), F.lit(0))


def _possible(differ: Column, similarity: float = SIMILARITY) -> Column:
    """Whether the lines x and y can have the similarity, ``differ`` shingles at least being of one only."""
    return differ * (1 + similarity) <= (1 - similarity) * (F.col("nx") + F.col("ny")) + 1e-6


def possible_pairs(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose bitmaps do not rule them out."""
    x = maps.select(F.col("d").alias("a"), F.col("n").alias("nx"), F.col("bits").alias("bitsx"))
    y = maps.select(F.col("d").alias("b"), F.col("n").alias("ny"), F.col("bits").alias("bitsy"))
    return pairs.join(x, "a").join(y, "b").where(_possible(_differ("x", "y"))).select("a", "b")


def wide_maps(texts: DataFrame) -> DataFrame:
    """``(d, m, wide)`` of ``texts(d, t)``: distinct shingles and their wider bitmap."""
    sizes = texts.select("d", F.size(F.array_distinct(_shingles("cast(t as binary)"))).alias("m"))
    return bitmaps(texts, WIDE_BITMAP).select("d", F.col("bits").alias("wide")).join(sizes, "d")


def _of(ends: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``texts`` of ``ends(w)``."""
    return texts.join(ends.distinct(), F.col("d") == F.col("w"), "left_semi")


def _wide_differ(a: str, b: str) -> Column:
    """As _differ; written out, so many longs would not fit a method."""
    return F.aggregate(F.zip_with(f"wide{a}", f"wide{b}", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)


def likelier_pairs(more: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b, c, differ)`` that wider bitmaps and the numbers of distinct shingles do not rule out; ``differ`` anew."""
    wide = stored(wide_maps(_of(more.select(F.explode(F.array("a", "b")).alias("w")), texts)), "line-wide")
    x = wide.select(F.col("d").alias("a"), F.col("m").alias("nx"), F.col("wide").alias("widex"))
    y = wide.select(F.col("d").alias("b"), F.col("m").alias("ny"), F.col("wide").alias("widey"))
    # The row number: summed once, not again in the filter.
    told = more.drop("differ").join(x, "a").join(y, "b").select(
        "a", "b", "c", "nx", "ny", _wide_differ("x", "y").alias("differ"), F.monotonically_increasing_id().alias("z"))
    return told.where(_possible(F.col("differ"))).select("a", "b", "c", "differ")


def unsettled_pairs(marks: DataFrame, buckets: DataFrame, parts: DataFrame, maps: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b, c, differ)``: the pairs of a bucket that are in different components and can have the similarity; c: of b.

    Lines of the largest component of a bucket need not meet each other: the
    others (a) meet all lines (b).  A bucket of many lines is dealt in blocks, so that no task
    has more than a few blocks of it.  The join itself asks wider bitmaps too, so
    that unlike lines of one template leave it with few pairs.
    """
    large = buckets.where("n > 3 or (n = 3 and lo = top)")
    inner = _with_buckets(marks, large).where("d <> lo and d <> top").select("k", "d")
    inner = stored(inner.join(parts, F.col("d") == F.col("node"), "left")
                   .select("k", "d", F.coalesce("component", "d").alias("c")), "line-inner")
    sizes = inner.groupBy("k", "c").agg(F.count(F.lit(1)).alias("m"))
    mixed = stored(sizes.groupBy("k").agg(F.max_by("c", F.expr(f"m * {1 << 24} + (xxhash64(c) & {(1 << 24) - 1})")).alias("main"),
                                          F.sum("m").alias("m"), F.max("m").alias("most"), F.count(F.lit(1)).alias("n_c"))
                   .where("n_c > 1").select("k", "main", F.expr(f"int((m + {BLOCK - 1}) div {BLOCK})").alias("my"),
                                            F.expr(f"int((m - most + {BLOCK - 1}) div {BLOCK})").alias("mx")), "line-mixed")
    apart = stored(inner.join(F.broadcast(mixed) if is_small(mixed, MAX_BROADCAST) else mixed, "k"), "line-apart")
    wide = stored(wide_maps(_of(apart.select(F.col("d").alias("w")), texts)), "line-wide")
    known = apart.join(maps.select("d", "bits"), "d").join(wide.withColumnRenamed("m", "n"), "d")
    place = lambda m: F.expr(f"int(pmod(xxhash64(d), {m}))")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    named = lambda df, e: df.select("k", "i", "j", *(F.col(c).alias(c + e) for c in ("d", "c", "n", "bits", "wide", "rest")))
    known = known.withColumn("rest", F.col("c") != F.col("main"))
    x = named(known.where("rest").withColumn("i", place("mx")).withColumn("j", every("my")), "x")
    y = named(known.withColumn("j", place("my")).withColumn("i", every("mx")), "y")
    met = x.join(y, (x["k"] == y["k"]) & (x["i"] == y["i"]) & (x["j"] == y["j"]) & (F.col("cx") != F.col("cy"))
                 & (~F.col("resty") | (F.col("dx") < F.col("dy"))) & _possible(_differ("x", "y")) & _possible(_wide_differ("x", "y")))
    return met.groupBy(F.col("dx").alias("a"), F.col("dy").alias("b")).agg(
        F.first("cy").alias("c"), F.min(_wide_differ("x", "y")).alias("differ"))


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs ``(a, b)`` whose shingle sets have the Jaccard similarity or more; ``texts(d, t)`` holds their lines."""
    both = (pairs.join(texts.select(F.col("d").alias("a"), F.col("t").cast("binary").alias("ta")), "a")
            .join(texts.select(F.col("d").alias("b"), F.col("t").cast("binary").alias("tb")), "b"))
    sets = both.select("a", "b", _shingles("ta").alias("sa"), _shingles("tb").alias("sb"))
    # The row number keeps the optimiser from writing out the lists wherever the filter uses them.
    common = sets.select("a", "b", "sa", "sb", F.size(F.array_intersect("sa", "sb")).alias("i"), F.monotonically_increasing_id().alias("z"))
    # Without repeats inside a line the first test is the whole one; the union is made only if it fails.
    return common.where((F.col("i") >= similarity * (F.size("sa") + F.size("sb") - F.col("i")))
                        | (F.col("i") >= similarity * F.size(F.array_union("sa", "sb")))).select("a", "b")


def _component(parts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with the components ``pa`` and ``pb`` of their lines."""
    of = lambda e: parts.select(F.col("node").alias(e), F.col("component").alias(f"p{e}"))
    return (pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
            .withColumn("pa", F.coalesce("pa", "a")).withColumn("pb", F.coalesce("pb", "b")))


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components with more links: union-find among the components that these join."""
    tops = _component(parts, links).select(F.col("pa").alias("a"), F.col("pb").alias("b"))
    wider = stored(connected_components(tops, "line-components"), "line-wider")
    to = wider.select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = parts.join(F.broadcast(to) if is_small(wider, MAX_BROADCAST) else to, "component", "left").select(
        "node", F.coalesce("to", "component").alias("component"))
    alone = wider.join(parts.select("node"), "node", "left_anti").select("node", "component")
    return stored(old.unionByName(alone), "line-parts")


def _all_components(marks: DataFrame, lines: DataFrame) -> DataFrame:
    """``(node, component)`` of the lines that are linked to another line."""
    buckets = stored(band_buckets(marks), "line-buckets")
    inside = _with_buckets(marks, buckets).select(F.col("d").alias("w")).distinct()
    texts = stored(_texts(stored(inside, "line-inside"), lines), "line-texts")
    maps = stored(bitmaps(texts), "line-bitmaps")
    pairs = possible_pairs(candidate_pairs(marks, buckets), maps)
    parts = stored(connected_components(verified(pairs, texts), "line-components"), "line-parts")
    more = stored(unsettled_pairs(marks, buckets, parts, maps, texts), "line-unsettled")
    if more.isEmpty():
        return parts
    if more.count() > texts.count():
        likely = more.groupBy("a", "c").agg(F.min_by("b", F.expr(f"bigint(differ) * {1 << 24} + (xxhash64(b) & {(1 << 24) - 1})")).alias("b"))
        parts = _joined(parts, verified(likely.select("a", "b"), texts))
        more = stored(_component(parts, more.select("a", "b")).where("pa <> pb").select("a", "b"), "line-left")
    return _joined(parts, verified(more.select("a", "b"), texts))


def removed_lines(docs: DataFrame) -> DataFrame:
    """``docs(l_key, l_text)`` -> ``(l_key, l_gone)``: numbers of the lines that go."""
    lines = _lines(docs)
    marks = stored(signatures(lines), "line-marks")
    parts = _all_components(marks, lines)
    named = stored(marks.select("d", "f").join(parts, F.col("d") == F.col("node"), "left").where("f > 1 or component is not null")
                   .select("d", F.coalesce("component", "d").alias("c")), "line-named")
    found = stored(lines.select("d", "rank").join(F.broadcast(named) if is_small(named, MAX_BROADCAST) else named, "d")
                   .select("c", "rank"), "line-found")
    first = stored(found.groupBy("c").agg(F.min("rank").alias("first")), "line-first")
    later = found.join(F.broadcast(first) if is_small(first, MAX_BROADCAST) else first, "c").where("rank > first")
    base = F.lit(_LINE_BASE).cast("decimal(10,0)")
    return (later.withColumn("pos", F.col("rank") % base)
            .select(((F.col("rank") - F.col("pos")) / base).cast("decimal(29,0)").alias("l_key"), F.col("pos").cast("int").alias("pos"))
            .groupBy("l_key").agg(F.collect_set("pos").alias("l_gone")))


def _cleaned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(l_row, l_new, l_lines, l_gone)``: the row as it was, its text afterwards, all lines, numbers of those removed."""
    rows = docs.select(document_key(F.col(id_col), F.col(text_col)).alias("l_key"),
                       F.struct(*docs.columns).alias("l_row"), F.col(text_col).alias("l_text"))
    gone = removed_lines(rows.select("l_key", "l_text"))
    at = F.sequence(F.lit(0), F.size("l_lines") - 1)
    out = (rows.join(gone, "l_key", "left").withColumn("l_lines", F.split("l_text", "\n"))
           .withColumn("l_gone", F.when(F.col("l_lines").isNotNull(), F.coalesce("l_gone", F.array().cast("array<int>"))))
           .withColumn("l_left", F.array_except(at, F.col("l_gone"))))
    text = F.array_join(F.transform("l_left", lambda i: F.get("l_lines", i)), "\n")
    return out.select("l_row", text.alias("l_new"), "l_lines", "l_gone")


def _columns(docs: DataFrame, text_col: str) -> list[Column]:
    return [F.col("l_new").alias(c) if c == text_col else F.col("l_row")[c].alias(c) for c in docs.columns]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its columns, the text without repeated lines, and ``l_lines``, ``l_removed`` (long).

    The earliest line of a component is that of the smallest id, then line
    number.  Null text stays null (no lines); blank lines take no part and
    stay.  Rows of one id and text are copies of one document and keep the
    same lines; rows of one id with different texts, and rows without an id
    (they rank last), are documents of their own in the order of a 31-bit hash
    of the text.  Ids are taken as non-negative.  Columns of ``docs`` named like the two counts are
    replaced by them.
    """
    own = [c for c, name in zip(_columns(docs, text_col), docs.columns) if name not in ("l_lines", "l_removed")]
    return _cleaned(docs, id_col, text_col).select(
        *own, F.coalesce(F.size("l_lines"), F.lit(0)).cast("long").alias("l_lines"),
        F.coalesce(F.size("l_gone"), F.lit(0)).cast("long").alias("l_removed"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with deduplicated text; documents of which nothing but blanks is left are dropped.

    A document that had no words to begin with stays as it was.
    """
    out = _cleaned(docs, id_col, text_col)
    left = (F.coalesce(F.size("l_gone"), F.lit(0)) == 0) | F.col("l_new").rlike(r"[^\x20\x09-\x0D]")
    return out.where(left).select(*_columns(docs, text_col))
