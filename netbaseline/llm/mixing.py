"""Mixing sources to target weights by systematic sampling.

Every source has a target (its weight's share of all words, at most ``cap``
times its own size; the excess is shared out again by weight).  A document's
expected copies are target / size of its source.  They are prefix-summed
within the source in the order of document size, one random offset per source
is added, and the document is emitted once per integer boundary crossed.
Since neighbours in that order have nearly equal sizes, the words taken stay
within about one document of the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored, word_count

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix-1"
ROWS_A_BUCKET = 1_000_000  # documents of one source and size are ranked in ranges of ids of about this many


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sizes(m_source, m_total)`` -> the same with ``m_target`` (double).

    Weights go to the sources in code point order, null last, and repeat.  The
    sources, one row each, are ranked in one window; the shares are settled by
    rounds over that table, each of which returns three numbers to the driver.
    """
    order = Window.orderBy(F.col("m_source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    ranked = stored(sizes.withColumn("m_weight", F.element_at(F.array(*map(F.lit, weights)), place + 1)), "mix-sources")
    most, total = cap * F.col("m_total"), ranked.agg(F.sum("m_total")).first()[0] or 0
    share, n_capped = None, -1
    while True:
        capped = F.lit(False) if share is None else F.col("m_weight") * F.lit(share) > most
        fixed, rest, n = ranked.agg(F.sum(F.when(capped, most)), F.sum(F.when(~capped, F.col("m_weight"))),
                                    F.count(F.when(capped, 1))).first()
        if n == n_capped or not rest:
            break
        share, n_capped = (total - (fixed or 0)) / rest, n
    share = F.lit(float(share or 0))
    return ranked.withColumn("m_target", F.least(F.col("m_weight") * share, most.cast("double"))).drop("m_weight")


def source_offset(source: Column, seed: str) -> Column:
    """The random offset of a source: 20 bits of a digest, in [0, 1)."""
    digest = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.concat(F.lit("s"), source), F.lit(""))))
    return F.conv(F.substring(digest, 1, 5), 16, 10).cast("double") / F.lit(float(1 << 20))


def id_ranges(ids: DataFrame, buckets: int) -> list:
    """Smallest ids of all ranges but the first; about equally many of the rows of ``ids(m_id)`` in each.

    Where the borders lie changes the size of the ranges, but not the order of ids.
    """
    at = F.array(*(F.lit(k / buckets) for k in range(1, buckets)))
    borders = ids.agg(F.percentile_approx("m_id", at, max(10_000, 10 * buckets))).first()[0] if buckets > 1 else []
    return sorted(set(borders or []))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED,
                carry: bool = False) -> DataFrame:
    """``(id, size, source_size, target, copies, taken)`` per row; ``carry`` adds the input row as struct ``row``.

    Size: words of the text (null: 0).  Null is a source of its own, after
    all others.  A source without words has target 0 and no copies.  Rows with
    equal ids each count; the order among equal (size, id) does not change
    what is taken.  Reruns agree: the offset depends on seed and source only.
    Documents of equal size are taken in the order of their ids, null first,
    whatever the number of rows.  A hot source is ranked by size and range of
    ids: no task holds all of it.
    """
    kept = [F.struct(*docs.columns).alias("row")] if carry else []
    rows = docs.select(F.col(id_col).alias("m_id"), F.col(source_col).alias("m_source"),
                       word_count(F.col(text_col)).alias("m_size"), *kept)
    # One count per source and size serves the source sizes and the ranks.
    counts = stored(rows.groupBy("m_source", "m_size").agg(F.count(F.lit(1)).alias("m_n")), "mix-sizes")
    n_rows = counts.agg(F.sum("m_n")).first()[0] or 0
    buckets = 1 + n_rows // ROWS_A_BUCKET
    targets = source_targets(counts.groupBy("m_source").agg(F.sum(F.col("m_size") * F.col("m_n")).alias("m_total")),
                             weights, cap)
    before = F.sum("m_n").over(Window.partitionBy("m_source").orderBy("m_size")
                               .rowsBetween(Window.unboundedPreceding, -1))
    key = lambda c: F.coalesce(F.concat(F.lit("s"), F.col(c)), F.lit(""))
    places = (counts.withColumn("m_before", F.coalesce(before, F.lit(0)))
              .withColumn("m_key", key("m_source")).select("m_key", "m_size", "m_before"))
    places = places.join(targets.select(key("m_source").alias("m_key"), "m_total", "m_target"), "m_key")
    # Ranges of ids in order, rows without an id in the first: ranking bucket after bucket is ranking by id.
    borders = F.lit(id_ranges(rows.select("m_id"), buckets)).cast("array<long>")
    bucket = F.when(F.col("m_id").isNull(), 0).otherwise(F.size(F.filter(borders, lambda b: b <= F.col("m_id"))))
    rows = rows.withColumn("m_key", key("m_source")).withColumn("m_bucket", bucket)
    inside = ["m_key", "m_size", "m_bucket"]
    if buckets > 1:
        within = F.sum("m_in").over(Window.partitionBy("m_key", "m_size").orderBy("m_bucket")
                                    .rowsBetween(Window.unboundedPreceding, -1))
        share = (rows.groupBy(*inside).agg(F.count(F.lit(1)).alias("m_in"))
                 .withColumn("m_skip", F.coalesce(within, F.lit(0))).drop("m_in"))
        places = places.join(share, ["m_key", "m_size"]).withColumn("m_before", F.col("m_before") + F.col("m_skip"))
        places = places.drop("m_skip")
        on = inside
    else:
        on = ["m_key", "m_size"]
    ranked = rows.withColumn("m_rank", F.row_number().over(Window.partitionBy(*inside).orderBy("m_id")))
    ranked = ranked.join(places, on).withColumn("m_rank", F.col("m_rank") + F.col("m_before"))
    rate = F.when(F.col("m_total") > 0, F.col("m_target") / F.col("m_total")).otherwise(F.lit(0.0))
    edge = lambda r: F.floor(source_offset(F.col("m_source"), seed) + rate * r)
    copies = edge(F.col("m_rank")) - edge(F.col("m_rank") - 1)
    return (ranked.withColumn("copies", copies.cast("long"))
            .select(F.col("m_id").alias(id_col), F.col("m_size").alias("size"), F.col("m_total").alias("source_size"),
                    F.col("m_target").alias("target"), "copies",
                    (F.col("copies") * F.col("m_size")).alias("taken"), *(["row"] if carry else [])))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document of ``docs``, all its columns, once per copy taken."""
    taken = mix_sources(docs, carry=True, **options).where("copies > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")
