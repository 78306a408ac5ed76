"""Substring dedup by hashing lines and their sentences.

Units are the lines of a text and the sentences of a line (a sentence ends
after ``.``, ``!`` or ``?`` and blanks, after an ideographic full stop or mark,
or at a line feed).  Units are normalised (lower case, blanks collapsed,
marks at the end left out) and hashed to 128 bits.  Of all units with one digest the earliest stays: smallest
document id, then position.  A whole line that repeats is cut, however short.
Inside lines that are new as a whole, runs of neighbouring repeated sentences
are cut if they have ``min_words`` words or ``min_chars`` characters besides
blanks (scripts without blanks have no words to count); shorter ones are common
speech.  The spans that were cut keep their offsets in the original text.

Only digests travel: one (digest, document) row per distinct unit of a
document is reduced map-side to the smallest document, so that a line shared
by a third of all documents is one row a task, and every document gets back
the digests it owns.  There is no join on digests and hence no hot key.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

MIN_WORDS = 25
MIN_CHARS = 200
LAST = (1 << 63) - 1       # rank of a document without an id
HELD_DIGESTS = 50_000      # digests that leave a task together, about
MARKS = ".!?\u3002\uff01\uff1f\uff61"   # that end a sentence; left out at the end of a unit
BORDER = re.compile("[.!?]+[ \t\r]+|[\u3002\uff01\uff1f\uff61]+|\n+")

UNIT_ROWS = "u_hi long, u_lo long, u_doc long, u_sub long"
CUT = "text string, n_units long, n_removed long, removed array<struct<lo: long, hi: long>>"


class Unit(NamedTuple):
    lo: int
    hi: int
    words: int
    chars: int        # without blanks
    digest: bytes     # of the sentence; empty without words


def _digest(norm: str) -> bytes:
    return xxhash.xxh3_128_digest(norm.rstrip(MARKS) or norm)


def lines_of(text: str) -> list[tuple[bytes, list[Unit]]]:
    """(digest of the line, its sentences) in order; blanks and line feeds after a sentence are part of it."""
    ends = [m.end() for m in BORDER.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    out, units, norms, at = [], [], [], 0
    for end in ends:
        if end == at:
            continue
        words = text[at:end].lower().split()
        norm = " ".join(words)
        units.append(Unit(at, end, len(words), len(norm) - len(words) + 1, _digest(norm) if words else b""))
        if words:
            norms.append(norm)
        if text[end - 1] == "\n" or end == len(text):
            # A line of one sentence is that sentence.
            whole = _digest(" ".join(norms)) if len(norms) > 1 else next((u.digest for u in units if u.digest), b"")
            out.append((whole, units))
            units, norms = [], []
        at = end
    return out


def _digest_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct digests of every document, some ``HELD_DIGESTS`` rows in a frame."""
    docs, subs, sizes, parts, held = [], [], [], [], 0

    def frame() -> pd.DataFrame:
        halves = np.frombuffer(b"".join(parts), "<i8").reshape(-1, 2)
        return pd.DataFrame({"u_hi": halves[:, 1], "u_lo": halves[:, 0],
                             "u_doc": np.repeat(np.array(docs, np.int64), sizes), "u_sub": np.repeat(np.array(subs, np.int64), sizes)})

    for batch in batches:
        for doc, sub, text in batch.itertuples(index=False):
            digests = {d for whole, units in lines_of(text) for d in (whole, *(u.digest for u in units)) if d}
            docs.append(doc)
            subs.append(sub)
            sizes.append(len(digests))
            parts.extend(digests)
            held += len(digests)
            if held >= HELD_DIGESTS:
                yield frame()
                docs, subs, sizes, parts, held = [], [], [], [], 0
    if held:
        yield frame()


def cut_repeats(text: str, owned: set[int], min_words: int, min_chars: int = MIN_CHARS) -> tuple[str, int, list[dict]]:
    """The text without its repeats, the number of sentences, and the spans cut; ``owned``: halves of digests."""
    lines, seen = lines_of(text), set()

    def repeats(digest: bytes) -> bool:
        again = digest in seen or int.from_bytes(digest[:8], "little", signed=True) not in owned
        seen.add(digest)
        return again

    marked: list[tuple[Unit, bool, bool]] = []           # (sentence, repeats, is cut with its line)
    for whole, units in lines:
        again = bool(whole) and repeats(whole)
        for u in units:
            one = again if u.digest == whole else bool(u.digest) and repeats(u.digest)
            marked.append((u, again or one, again))
    spans: list[dict] = []

    def close(run: list[tuple[Unit, bool, bool]]) -> None:
        long = sum(u.words for u, _, _ in run) >= min_words or sum(u.chars for u, _, _ in run if u.digest) >= min_chars
        for u, _, with_line in run:
            if not (long or with_line):
                continue
            if spans and spans[-1]["hi"] == u.lo:
                spans[-1]["hi"] = u.hi
                spans[-1]["n"] += bool(u.digest)
            else:
                spans.append({"lo": u.lo, "hi": u.hi, "n": int(bool(u.digest))})

    run: list[tuple[Unit, bool, bool]] = []
    for entry in marked:
        if entry[1] or (run and not entry[0].digest):
            run.append(entry)
        else:
            close(run)
            run = []
    close(run)
    left, at = [], 0
    for s in spans:
        left.append(text[at:s["lo"]])
        at = s["hi"]
    return "".join([*left, text[at:]]), len(marked), spans


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(id, text, n_units, n_removed, removed)`` per row of ``docs``.

    ``removed`` holds the spans cut, (lo, hi) in code points of the original
    text, ``n_removed`` the sentences in them, ``n_units`` all sentences.  Null
    text stays null (no units); an empty text has none.  Rows of one id with
    different texts are documents of their own, in the order of a hash of the
    text; rows of one id and text are copies of one document and own the same
    units.  Rows without an id rank last.  Extra columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("u_id"), F.col(text_col).alias("u_text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("u_doc"), F.xxhash64(text_col).alias("u_sub"))
    digests = rows.where("u_text is not null").select("u_doc", "u_sub", "u_text").mapInPandas(_digest_rows, UNIT_ROWS)
    # The text's hash only decides between rows of one id; as one decimal the rank reduces in a hash aggregate.
    wide = F.col("u_doc").cast("decimal(19,0)") * F.lit(1 << 62).cast("decimal(19,0)") + F.shiftrightunsigned("u_sub", 2)
    owners = digests.groupBy("u_hi", "u_lo").agg(F.min(wide.cast("decimal(38,0)")).alias("u_rank"))
    owned = owners.groupBy("u_rank").agg(F.collect_list("u_lo").alias("u_owned"))

    @F.pandas_udf(CUT)
    def cut(texts: pd.Series, owns: pd.Series) -> pd.DataFrame:
        out = []
        for text, own in zip(texts, owns):
            if text is None:
                out.append((None, 0, 0, []))
                continue
            left, n, spans = cut_repeats(text, set() if own is None else set(own.tolist()), min_words, min_chars)
            out.append((left, n, sum(s["n"] for s in spans), [{"lo": s["lo"], "hi": s["hi"]} for s in spans]))
        return pd.DataFrame(out, columns=["text", "n_units", "n_removed", "removed"])

    ranked = rows.select("u_id", "u_text", wide.cast("decimal(38,0)").alias("u_rank"))
    return (ranked.join(owned, "u_rank", "left").withColumn("u_cut", cut("u_text", "u_owned"))
            .select(F.col("u_id").alias(id_col), "u_cut.text", "u_cut.n_units", "u_cut.n_removed", "u_cut.removed"))
