"""Byte-level BPE encoding and decoding by speculation and verification.

1. Speculate: a greedy longest match over the piece's bytes proposes tokens.
2. Verify: a token sequence is the BPE result exactly if every token is the
   BPE result of its own bytes and every adjacent pair is *compatible*: with
   the merges of both tokens undone step by step, latest first, no merge
   across their border could have been applied earlier.  The pairs of all
   proposed pieces of a batch are tested together in numpy.
3. Only the pieces with an incompatible pair go through exact merging.

Encodings of whole units (blanks and the word after them) are remembered in a
bounded per-worker table, so that frequent words cost one dictionary lookup.
"""

from __future__ import annotations

import functools
import gc
import heapq
import json
import re
from collections.abc import Iterable
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, functions as F
from pyspark.sql.types import BinaryType, StringType

# The byte-level split pattern and Unicode White_Space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK = "\t-\r \x85\xa0" + "".join(map(chr, (0x1680, 0x2000))) + "-" + "".join(map(
    chr, (0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

MAX_UNITS = 250_000        # remembered units per worker and generation (two generations are kept)
MAX_UNIT_CHARS = 48        # longer units are encoded each time
SUB_BATCH_CHARS = 1 << 18  # texts whose new units are verified together
NO_RANK = np.iinfo(np.int64).max
HASH = np.uint64(0x9E3779B97F4A7C15)  # multiplicative hashing by the golden ratio


def _byte_alphabet() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Known(dict):
    """Unit -> packed ids; a unit that isn't there is noted in ``missing`` and gives None."""

    def __init__(self) -> None:
        self.missing: list[str] = []

    def __missing__(self, unit: str) -> None:
        self.missing.append(unit)


class ByteBpe:
    """Tables of one tokenizer file (``tokenizers`` JSON: byte-level BPE without normaliser)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("normalizer") or spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        alphabet = _byte_alphabet()
        raw = lambda token: bytes(alphabet[c] for c in token)
        vocab = spec["model"]["vocab"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = raw(token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t in spec["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError(f"{path}: added token {t['content']!r} takes its surroundings")
            self.token_bytes[t["id"]] = t["content"].encode()
        self.byte_ids = [vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]

        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.pair = {}                                         # (left, right) -> (rank, merged id)
        self.rank = np.full(size, -1, np.int64)                # of the merge that makes a token
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        ordered = True
        for r, (a, b) in enumerate(merges):
            x, y, t = vocab[a], vocab[b], vocab[a + b]
            if (x, y) not in self.pair:
                self.pair[x, y] = (r, t)
            ordered &= self.rank[t] < 0 and max(self.rank[x], self.rank[y]) < r
            if self.rank[t] < 0:
                self.rank[t], self.left[t], self.right[t] = r, x, y
        self.size = size
        self._hash_pairs()
        # Tokens that may be proposed: those that BPE makes from their own bytes.
        sound = np.zeros(size, bool)
        sound[self.byte_ids] = True
        if ordered:
            made = np.flatnonzero(self.rank >= 0)
            fits = self.compatible(self.left[made], self.right[made], first=False)
            for t, ok in sorted(zip(made.tolist(), fits.tolist()), key=lambda x: self.rank[x[0]]):
                sound[t] = ok and sound[self.left[t]] and sound[self.right[t]]
        self.lengths = np.array([len(b) for b in self.token_bytes], np.int64)
        self.matcher = ahocorasick.Automaton()
        for i in np.flatnonzero(sound).tolist():
            self.matcher.add_word(self.token_bytes[i].decode("latin-1"), i)
        self.matcher.make_automaton()
        self.ordered = ordered
        self.split = regex.compile(SPLIT)
        self.units = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
        self.specials = (re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
                         if self.special else None)
        self.known = Known()                                   # this generation of remembered units
        self.older: dict[str, bytes] = {}                      # the one before
        self.checked = self.merged = 0                         # pieces verified, pieces merged exactly

    def _hash_pairs(self) -> None:
        """Open-addressing table of the merges, an eighth full, for vectorised lookups."""
        self.keys = np.array([x * self.size + y for x, y in self.pair], np.int64)
        self.key_ranks = np.array([r for r, _ in self.pair.values()], np.int64)
        self.key_ids = np.array([t for _, t in self.pair.values()], np.int64)
        bits = max(4, (8 * len(self.keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int64)
        for k, at in enumerate(((self.keys.astype(np.uint64) * HASH) >> self.shift).tolist()):
            while self.slots[at] >= 0:
                at = (at + 1) % len(self.slots)
            self.slots[at] = k

    def _merge_slot(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Where a pair stands in the hashed table of merges; -1: it does not merge."""
        key = x * self.size + y
        at = (key * HASH) >> self.shift
        out = np.full(len(key), -1, np.int64)
        todo = np.arange(len(key))
        while len(todo):
            slot = self.slots[at[todo].astype(np.int64)]
            hit = (slot >= 0) & (self.keys[slot] == key[todo].astype(np.int64))
            out[todo[hit]] = slot[hit]
            todo = todo[(slot >= 0) & ~hit]
            at[todo] = (at[todo] + np.uint64(1)) & np.uint64(len(self.slots) - 1)
        return out

    def _merge_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        slot = self._merge_slot(x.astype(np.uint64), y.astype(np.uint64))
        return np.where(slot >= 0, self.key_ranks[slot], NO_RANK)

    def compatible(self, left: np.ndarray, right: np.ndarray, first: bool = True) -> np.ndarray:
        """Whether BPE leaves each pair of neighbours as it is.

        Walks back in time: x and y are the tokens that touch the border, px
        and py the ranks at which they were merged into what came later.  A
        merge of x and y goes ahead of those if its rank is lower; at equal
        ranks the one further left is first.  ``first=False`` leaves out the
        merge of the pair itself (to test whether a token is sound).
        """
        x, y = np.array(left, np.int64), np.array(right, np.int64)
        px, py = np.full(len(x), NO_RANK), np.full(len(x), NO_RANK)
        ok, todo = np.ones(len(x), bool), np.arange(len(x))
        while len(todo):
            xs, ys = x[todo], y[todo]
            if first:
                q = self._merge_rank(xs, ys)
                ok[todo[(q != NO_RANK) & (q < px[todo]) & (q <= py[todo])]] = False
            first = True
            rx, ry = self.rank[xs], self.rank[ys]
            more = ok[todo] & ((rx >= 0) | (ry >= 0))
            todo, xs, ys, rx, ry = todo[more], xs[more], ys[more], rx[more], ry[more]
            undo_x = rx > ry
            a, b = todo[undo_x], todo[~undo_x]
            px[a], x[a] = rx[undo_x], self.right[xs[undo_x]]
            py[b], y[b] = ry[~undo_x], self.left[ys[~undo_x]]
        return ok

    def _propose(self, joined: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leftmost longest matches over all pieces in one pass: (token, number of its piece).

        No token holds the character between two pieces, so no match spans them.
        """
        hits = np.fromiter(chain.from_iterable(self.matcher.iter_long(joined)), np.int64).reshape(-1, 2)
        return hits[:, 1], np.searchsorted(np.cumsum(sizes + 1) - 1, hits[:, 0], side="right")

    def merge(self, piece: bytes) -> list[int]:
        """Exact merging: lowest rank first, leftmost among equals (a heap over a linked list)."""
        ids = [self.byte_ids[b] for b in piece]
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(hit[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (hit := self.pair.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, x, y = heapq.heappop(heap)
            j = after[i] if ids[i] == x else -1
            if j < 0 or ids[j] != y:
                continue
            ids[i], ids[j], after[i] = self.pair[x, y][1], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q >= 0 and (hit := self.pair.get((ids[p], ids[q]))):
                    heapq.heappush(heap, (hit[0], p, ids[p], ids[q]))
        return [t for t in ids if t >= 0]

    def merge_all(self, raw: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many pieces side by side: (their tokens in order, tokens per piece).

        In each step every piece applies its lowest-ranked merge wherever it
        occurs, from the left.  This is the sequential order, as a merge can
        only open pairs of higher rank (checked when the file was loaded).
        """
        ends = np.cumsum(sizes)
        if not self.ordered:
            lists = [self.merge(raw[b - n:b]) for b, n in zip(ends.tolist(), sizes.tolist())]
            return np.array([t for ids in lists for t in ids], np.int64), np.array([len(ids) for ids in lists], np.int64)
        ids = np.array(self.byte_ids, np.int64)[np.frombuffer(raw, np.uint8)]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            slot = np.full(len(ids), -1, np.int64)
            slot[:-1] = self._merge_slot(ids[:-1].astype(np.uint64), ids[1:].astype(np.uint64))
            slot[:-1][owner[:-1] != owner[1:]] = -1
            rank = np.where(slot >= 0, self.key_ranks[slot], NO_RANK)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(ids)]))
            drop = least == NO_RANK
            done.append((owner[drop], ids[drop]))
            at = np.flatnonzero((rank == least) & ~drop)
            if len(at):
                # Overlapping occurrences (x x x): every second one of a run, from its left end.
                head = np.r_[True, np.diff(at) != 1]
                at = at[(at - at[head][np.cumsum(head) - 1]) % 2 == 0]
                ids[at] = self.key_ids[slot[at]]
                drop[at + 1] = True
            ids, owner = ids[~drop], owner[~drop]
        owner, ids = (np.concatenate(x) for x in zip(*done))
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(sizes))

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Speculate, verify all adjacent pairs at once, merge exactly where a pair failed.

        Returns the tokens of all (non-empty) pieces in order and the number of each piece's tokens.
        """
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        spelling = [p if p.isascii() else p.encode().decode("latin-1") for p in pieces]  # a character per byte
        sizes = np.fromiter(map(len, spelling), np.int64, len(spelling))
        tokens, owner = self._propose(chr(256).join(spelling), sizes)
        # A proposal must spell its piece and each of its neighbouring pairs must be compatible.
        good = np.bincount(owner, self.lengths[tokens], minlength=len(pieces)) == sizes
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, where = np.unique(tokens[inner] * self.size + tokens[inner + 1], return_inverse=True)
        fits = self.compatible(pairs // self.size, pairs % self.size)[where]
        good[owner[inner[~fits]]] = False
        counts = np.bincount(owner, minlength=len(pieces))
        failed = np.flatnonzero(~good)
        self.checked += len(pieces)
        self.merged += len(failed)
        if not len(failed):
            return tokens, counts
        merged, n = self.merge_all("".join([spelling[k] for k in failed.tolist()]).encode("latin-1"), sizes[failed])
        counts[failed] = n
        out = np.empty(int(counts.sum()), np.int64)
        ours = np.repeat(good, counts)
        out[ours], out[~ours] = tokens[good[owner]], merged
        return out, counts

    def _learn(self, units: Iterable[str]) -> dict[str, bytes]:
        """Encodings (little-endian unsigned 32-bit) of units not met before."""
        single, parts = [], {}
        for u in units:
            if (u[1:] if u[0] == " " else u).isalpha():
                single.append(u)                       # letters after at most one space: one piece
            else:
                parts[u] = self.split.findall(u)
        shared = list({p for ps in parts.values() for p in ps})
        tokens, counts = self.encode_pieces(single + shared)
        flat, ends = tokens.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        ids = [flat[a:b] for a, b in zip([0, *ends], ends)]
        of = dict(zip(shared, ids[len(single):]))
        out = dict(zip(single, ids))
        out.update((u, b"".join([of[p] for p in ps])) for u, ps in parts.items())
        return out

    def segments(self, text: str) -> list[str]:
        """The text cut at its units; a special string is a segment of its own."""
        if self.specials is None or not any(s in text for s in self.special):
            return self.units.findall(text)
        out = []
        for k, part in enumerate(self.specials.split(text)):
            out += [part] if k % 2 else self.units.findall(part)
        return out

    def encode_units(self, unit_lists: list[list[str]]) -> list[list[bytes]]:
        """The packed ids of every unit; what is new in the batch is learnt together."""
        known, older, missing = self.known, self.older, self.known.missing
        missing.clear()
        out = [list(map(known.__getitem__, units)) for units in unit_lists]
        if missing:
            new = set(missing)
            found = {u: older[u] for u in new if u in older}
            new.difference_update(found)
            special = new & self.special.keys()
            found.update((s, np.asarray([self.special[s]], "<u4").tobytes()) for s in special)
            found.update(self._learn(new - special))
            out = [[found[u] if x is None else x for u, x in zip(units, ids)] for units, ids in zip(unit_lists, out)]
            known.update((u, x) for u, x in found.items() if len(u) <= MAX_UNIT_CHARS)
            if len(known) > MAX_UNITS:
                self.older, self.known = known, Known()
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        return [b"".join(x) for x in self.encode_units([self.segments(t) for t in texts])]

    def decode(self, ids: bytes) -> str:
        table = self.token_bytes
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    """One set of tables per worker process (left out of later garbage collections)."""
    tables = ByteBpe(path)
    gc.freeze()
    return tables


def sub_batches(texts: Iterable[str | None], limit: int = SUB_BATCH_CHARS) -> Iterable[list[str]]:
    """Consecutive texts of about ``limit`` characters together (null: empty)."""
    batch, size = [], 0
    for t in texts:
        batch.append(t or "")
        size += len(batch[-1])
        if size >= limit:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def bpe_encode(text: Column, path: str) -> Column:
    """Token ids of a text as packed little-endian unsigned 32-bit integers.

    The same ids as ``tokenizers.Tokenizer.from_file(path).encode(text,
    add_special_tokens=False)``.  Null and empty texts give empty ids.  A
    worker's memory is bounded by one Arrow batch and the unit table.
    """
    @F.pandas_udf(BinaryType())
    def encode(texts: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([ids for batch in sub_batches(texts) for ids in bpe.encode_batch(batch)], dtype=object)

    return encode(text)


def bpe_decode(ids: Column, path: str) -> Column:
    """The text of packed ids, special tokens included; null ids give the empty text.

    Byte sequences that are no UTF-8 become U+FFFD, as the library's decoder has it.
    """
    @F.pandas_udf(StringType())
    def decode(packed: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([bpe.decode(x or b"") for x in packed], dtype=object)

    return decode(ids)


def bpe_round_trip(text: Column, path: str) -> Column:
    """Struct of ``ids`` (as :func:`bpe_encode` gives them) and ``decoded``, their decoding.

    One Python function: chained ones would encode every text a second time
    to decode it.
    """
    @F.pandas_udf("ids binary, decoded string")
    def both(texts: pd.Series) -> pd.DataFrame:
        bpe = load(path)
        ids = [x for batch in sub_batches(texts) for x in bpe.encode_batch(batch)]
        return pd.DataFrame({"ids": pd.Series(ids, dtype=object),
                             "decoded": pd.Series([bpe.decode(x) for x in ids], dtype=object)})

    return both(text)
