import random
import string

from pyspark.sql import functions as F

from netbaseline.llm import line_dedup as L

BASE = "The quick brown fox jumps over the lazy dog while the sun goes down behind the distant hills of the valley"
EDIT = BASE.replace("lazy", "tired")


def shingles(line):
    raw = line.strip(" \t\r").lower().encode()
    return {raw[k:k + L.SHINGLE] for k in range(len(raw) - L.SHINGLE + 1)}


def key(doc, text):
    return L.LAST if doc is None else doc, text


def brute(rows):
    """All pairs of lines, components, the earliest line of each stays."""
    lines = sorted(((key(d, t), k, x) for d, t in set(rows) if t is not None
                    for k, x in enumerate(t.split("\n")) if len(x.strip(" \t\r").lower().encode()) >= L.MIN_BYTES),
                   key=lambda r: r[:2])
    sets = [shingles(x) for _, _, x in lines]
    top = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c >= L.SIMILARITY * (len(sets[i]) + len(sets[j]) - c):
                a, b = top[i], top[j]
                top = [min(a, b) if t in (a, b) else t for t in top]
    kept = {lines[t][:2] for t in set(top)}
    gone = {r[:2] for r in lines} - kept
    return sorted(str((d, None if t is None else "\n".join(
        x for k, x in enumerate(t.split("\n")) if (key(d, t), k) not in gone))) for d, t in rows)


def test_equals_brute_force(spark):
    rows = [(1, BASE + "\nshort\nSomething of its own that nobody else has ever said before"), (2, "  " + BASE.upper() + " \nshort"),
            (3, EDIT + "\n" + EDIT + "\n" + BASE), (4, None), (5, ""), (6, "\n\n"), (7, "é" * 40 + "\n" + "é" * 41),
            (8, "z" * 20_000 + "\n" + "ab " * 5000), (9, "ab " * 5000), (10, "Entirely different words here\r"),
            (11, "entirely different words here"), (None, BASE + "\nA line without an id stays because it is new"), (4, "second row")]
    rows += [(20 + k, f"Line number {k} speaks of {k * 7919} things and {k * 104729} others, all of them unlike") for k in range(60)]
    df = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, l_gone int")
    out = L.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "l_gone", "l_lines", "l_removed"]
    assert sorted(str((r["doc_id"], r["text"])) for r in out.collect()) == brute(rows)
    left = {r["doc_id"]: r["text"] for r in L.without_repeats(df).collect()}
    assert 9 not in left and 11 not in left and left[5] == "" and left[6] == "\n\n"
    assert L.dedup_lines(df.where("false")).collect() == []


def test_near_lines_are_found(spark):
    """Recall over edited lines of the test data: at 0.8 and more nearly all pairs are found."""
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    lines = sorted({x for t in texts for x in t.split("\n") if 150 < len(x) < 400})[:300]
    rows = []
    for k, x in enumerate(lines):
        words = x.split(" ")
        words[len(words) // 2] = f"edit{k}"
        rows += [(2 * k, x), (2 * k + 1, " ".join(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(str((r["doc_id"], r["text"])) for r in L.dedup_lines(df).collect())
    want = brute(rows)
    assert len(set(got) ^ set(want)) <= 4


def test_rows_without_id_and_of_one_id(spark):
    """Different texts without an id, or of one, are documents of their own; equal rows are copies of one."""
    for d in (None, 7):
        df = spark.createDataFrame([(d, f"{BASE}\nown line {k}") for k in (1, 2, 3, 3)], "doc_id long, text string")
        got = [r["text"] for r in L.dedup_lines(df).collect()]
        kept = {x for x in got if BASE in x}
        assert len(kept) == 1 and len(got) == 4 and {x.split("\n")[-1] for x in got} == {f"own line {k}" for k in (1, 2, 3)}


def test_no_python_in_the_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = L.dedup_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_pairs_of_any_length_are_found(spark):
    """A line and itself plus a full stop, below, across and above 64 bytes; edits near 0.8 of 80 to 100 bytes."""
    rng, rows = random.Random(4), []
    for n in (40, 63, 64, 65, 90):
        for _ in range(40):
            x = "".join(rng.choice(string.ascii_lowercase) for _ in range(n))
            rows += [(len(rows), x), (len(rows) + 1, x + ".")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {r["doc_id"] for r in L.dedup_lines(df).where("l_removed = 1").collect()}
    assert gone == {d for d, _ in rows if d % 2}
    near = []
    for _ in range(1000):
        x = "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randrange(80, 101)))
        cut = next(k for k in range(1, len(x)) if len(shingles(x[k:])) < 0.82 * len(shingles(x)))
        near += [(len(near), x), (len(near) + 1, x[cut:])]
    df = spark.createDataFrame(near, "doc_id long, text string")
    assert L.dedup_lines(df).where("l_removed = 1").count() >= 975


def test_large_template_family(spark):
    """Lines of one template that are unlike each other, but for a near copy of each: every pair is found."""
    rng, rows = random.Random(7), []
    word = lambda n: "".join(rng.choice(string.ascii_lowercase) for _ in range(n))
    template = word(100)
    for k in range(500):
        x = template + word(23)
        rows += [(2 * k, x), (2 * k + 1, x + word(12))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {str((r["doc_id"], r["text"])) for r in L.dedup_lines(df).collect()}
    sets = [shingles(x) for _, x in rows]
    similar = lambda a, b: len(a & b) >= L.SIMILARITY * len(a | b)
    gone = {b for b in range(len(sets)) for a in range(b) if similar(sets[a], sets[b])}
    assert gone == set(range(1, 1000, 2))
    want = {str((d, "" if d in gone else x)) for d, x in rows}
    assert len(got ^ want) <= 2


def test_family_of_long_lines(spark):
    """Variants of one long line, many of them too far from the most frequent one: links through others are found."""
    rng = random.Random(11)
    words = ["".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randrange(3, 9))) for _ in range(150)]
    rows = [(k, " ".join(words)) for k in range(3)]
    for k in range(3, 160):
        w = list(words)
        for at in rng.sample(range(150), rng.randrange(4, 22)):
            w[at] = f"edit{rng.randrange(6)}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(str((r["doc_id"], r["text"])) for r in L.dedup_lines(df).collect())
    assert len(set(got) ^ set(brute(rows))) <= 4


def test_blocks_of_a_bucket(spark, monkeypatch):
    """Small blocks: the same links as with one block a bucket."""
    rng = random.Random(9)
    template, rows = "".join(rng.choice(string.ascii_lowercase) for _ in range(100)), []
    for k in range(40):
        x = template + "".join(rng.choice(string.ascii_lowercase) for _ in range(23))
        rows += [(2 * k, x), (2 * k + 1, x + "abcdefghijkl")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(L, "BLOCK", 5)
    assert {r["doc_id"] for r in L.dedup_lines(df).where("l_removed = 1").collect()} == set(range(1, 80, 2))


def test_short_lines_repeat_too(spark):
    rows = [(1, "Menu\n\n你好世界\nof its own\nab"), (2, "menu \n\n 你好世界\nMenus\nab\nab"), (3, "Read more...\nx\n \nab"), (4, "read more...\ny")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: (r["text"], r["l_removed"]) for r in L.dedup_lines(df).collect()}
    assert out == {1: (rows[0][1], 0), 2: ("\nMenus", 4), 3: ("Read more...\nx\n ", 1), 4: ("y", 1)}


def test_signatures_without_texts(spark):
    """Signatures are made before the shuffle: neither texts nor ranks travel, and nothing is sorted."""
    rows = spark.createDataFrame([(1, f"{BASE}\n{BASE} \nab\n{EDIT}"), (2, f"{BASE.upper()}\nAB")], "l_key long, l_text string")
    marks = L.signatures(L._lines(rows.select(rows["l_key"].cast("decimal(29,0)").alias("l_key"), "l_text")))
    plan = marks._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1 and "rank" not in plan
    want = {len(BASE) - L.SHINGLE + 1: 3, len(EDIT) - L.SHINGLE + 1: 1, 0: 2}
    assert {r["n"]: r["f"] for r in marks.collect()} == want


def test_links_of_near_copies(spark):
    """A family of near copies needs two links a line and band at most; pairs that can not be alike are ruled out unread."""
    rng, rows = random.Random(13), []
    for k in range(200):
        words = BASE.split(" ") * 3
        words[rng.randrange(len(words))] = f"edit{k}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, "ab" * 20 + "".join(rng.choice(string.ascii_lowercase) for _ in range(200))) for k in range(50)]
    docs = spark.createDataFrame(rows, "l_key long, l_text string")
    lines = L._lines(docs.select(docs["l_key"].cast("decimal(29,0)").alias("l_key"), "l_text")).cache()
    marks = L.signatures(lines).cache()
    buckets = L.band_buckets(marks).cache()
    pairs = L.candidate_pairs(marks, buckets).cache()
    assert pairs.count() <= sum(2 * b["n"] - 2 for b in buckets.collect())
    family = {r["d"] for r in lines.where("rank < 1000 * 4294967296").collect()}
    texts = lines.selectExpr("d", "norm AS t")
    left = L.possible_pairs(pairs, L.bitmaps(texts))
    right = {(r["a"], r["b"]) for r in L.verified(pairs, texts).collect()}
    assert right <= {(r["a"], r["b"]) for r in left.collect()}
    other = spark.createDataFrame([sorted((x, y)) for x, y in zip(sorted(family), sorted({r["d"] for r in lines.collect()} - family))], "a long, b long")
    assert L.possible_pairs(other, L.bitmaps(texts)).count() == 0
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(str((r["doc_id"], r["text"])) for r in L.dedup_lines(df).collect()) == brute(rows)


def test_wide_bitmaps_leave_few_pairs(spark):
    """Long lines a little too far from each other: wider bitmaps rule most pairs out and lose none that is alike."""
    rng, rows = random.Random(17), []
    words = ["".join(rng.choice(string.ascii_lowercase) for _ in range(7)) for _ in range(70)]
    for k in range(40):
        w = list(words)
        for at in rng.sample(range(70), rng.randrange(1, 6)):
            w[at] = f"word{rng.randrange(100, 1000)}"
        rows.append((k, " ".join(w)))
    texts = spark.createDataFrame(rows, "d long, t string").cache()
    sets = [shingles(x) for _, x in rows]
    alike = {(a, b) for b in range(40) for a in range(b) if len(sets[a] & sets[b]) >= L.SIMILARITY * len(sets[a] | sets[b])}
    every = texts.selectExpr("d AS a").join(texts.selectExpr("d AS b", "d AS c", "0 AS differ")).where("a < b")
    narrow = {(r["a"], r["b"]) for r in L.possible_pairs(every.select("a", "b"), L.bitmaps(texts)).collect()}
    wide = {(r["a"], r["b"]) for r in L.likelier_pairs(every, texts).collect()}
    assert alike and alike <= wide <= narrow and 2 * len(wide - alike) < len(narrow - alike)
    assert {(r["a"], r["b"]) for r in L.verified(every.select("a", "b"), texts).collect()} == alike


def _plan_parts(docs):
    lines = L._lines(docs.select(docs["l_key"].cast("decimal(29,0)").alias("l_key"), "l_text")).cache()
    marks = L.signatures(lines).cache()
    return lines, marks, L.band_buckets(marks).cache()


def test_blocks_leave_few_unlike_pairs(spark):
    """Unlike long lines of one template: the join of the blocks itself leaves few of their pairs, and all that are alike."""
    rng, rows = random.Random(23), []
    words = ["".join(rng.choice(string.ascii_lowercase) for _ in range(7)) for _ in range(300)]
    for k in range(130):
        w = list(words)
        for at in rng.sample(range(300), rng.randrange(10, 20)):
            w[at] = f"w{rng.randrange(100000, 1000000)}"
        rows.append((k, " ".join(w)))
    docs = spark.createDataFrame(rows, "l_key long, l_text string")
    lines, marks, buckets = _plan_parts(docs)
    texts = lines.selectExpr("d", "norm AS t")
    known = {r["t"]: r["d"] for r in texts.collect()}
    sets = {known[x]: shingles(x) for _, x in rows}
    members = L._with_buckets(marks, buckets).select("k", "d").collect()
    ends = {(b["k"], e) for b in buckets.collect() for e in (b["top"], b["lo"])}
    by = {}
    for r in members:
        if (r["k"], r["d"]) not in ends:
            by.setdefault(r["k"], []).append(r["d"])
    met = {(min(a, b), max(a, b)) for ds in by.values() for a in ds for b in ds if a != b}
    alike = {p for p in met if len(sets[p[0]] & sets[p[1]]) >= L.SIMILARITY * len(sets[p[0]] | sets[p[1]])}
    parts = spark.createDataFrame([], "node long, component long")
    got = {(min(r["a"], r["b"]), max(r["a"], r["b"]))
           for r in L.unsettled_pairs(marks, buckets, parts, L.bitmaps(texts), texts).collect()}
    pairs = spark.createDataFrame(sorted(met), "a long, b long")
    narrow = {(r["a"], r["b"]) for r in L.possible_pairs(pairs, L.bitmaps(texts)).collect()}
    assert met and alike <= got <= met
    assert 2 * len(got - alike) < len(narrow - alike)


def test_rows_of_several_shingles(spark):
    """One row of an aggregate stands for several shingles; signatures and bitmaps are those of all of them, whatever the length."""
    rng = random.Random(29)
    texts = ["".join(rng.choice("abc é") for _ in range(n)).strip() or "a" for n in (1, 7, 8, 9, 10, 11, 12, 13, 15, 16, 17, 40, 133)]
    lines = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "d long, norm string")
    rows = L._spread(lines.selectExpr("d", "cast(norm AS binary) AS b"))
    size = {k: max(len(x.encode()) - L.SHINGLE + 1, 0) for k, x in enumerate(texts)}
    assert rows.count() == sum(max(1, -(-n // L.AT_ONCE)) for n in size.values())
    one = spark.createDataFrame([(k, x.encode()[p:p + L.SHINGLE]) for k, x in enumerate(texts) for p in range(size[k])], "d long, s binary")
    seeds = L._seeds(L.BANDS * L.ROWS)
    want = one.groupBy("d").agg(*(F.min(F.expr(f"hash(hash(s), {k // L.ROWS}) ^ int({s})")).alias(f"m{k}") for k, s in enumerate(seeds)),
                                F.collect_set(F.expr("hash(s)")).alias("h")).collect()
    got = {r["d"]: r for r in L.signatures(lines).collect()}
    assert {k: r["n"] for k, r in got.items()} == size and len(want) == sum(n > 0 for n in size.values())
    maps = {longs: {r["d"]: r for r in L.bitmaps(lines.where("octet_length(norm) >= 8").selectExpr("d", "norm AS t"), longs).collect()}
            for longs in (L.BITMAP, L.WIDE_BITMAP)}
    for r in want:
        assert got[r["d"]]["minima"] == [r[f"m{k}"] for k in range(len(seeds))]
        for longs, of in maps.items():
            bits = [0] * longs
            for h in r["h"]:
                bits[(h >> 6) & (longs - 1)] |= 1 << (h & 63)
            assert of[r["d"]]["n"] == size[r["d"]] and [b & ((1 << 64) - 1) for b in of[r["d"]]["bits"]] == bits


def test_blank_ends(spark):
    """Lines with blank ends are trimmed as before, others are not looked at: tab, space and return only."""
    lines = ["", " ", "\t\r ", "Ab", " Ab", "Ab\r", "\t Ab\t", "Ab\x0b", "\xa0Ab\xa0", "É ", "é b"]
    df = spark.createDataFrame([(x,) for x in lines] + [(None,)], "x string")
    assert [r[0] for r in df.select(L._normal(F.col("x"))).collect()] == [x.strip(" \t\r").lower() for x in lines] + [None]
