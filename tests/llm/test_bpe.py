import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from netbaseline.llm import bpe, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
EDGES = ["", " ", "  a  b\n\n c ", "x <|endoftext|>y<|endoftext|><|endoftext", "\x1c\x1d a\x85b\u3000c", "a" * 700,
         "it's they'RE 12,345 --!!", "日本語のテキスト 🙂🙂👍🏽", "\r\n\t \u200b\ufeff", "Ünïcödé ß ﬁ", "word " * 3000]


def library(text: str) -> list[int]:
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tables():
    return bpe.ByteBpe(PATH)


def test_equals_library(tables):
    for text, ids in zip(EDGES, tables.encode_batch(EDGES)):
        assert np.frombuffer(ids, "<u4").tolist() == library(text)
        assert tables.decode(ids) == LIBRARY.decode(library(text), skip_special_tokens=False) == text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abest ion'\n\t.,A9é<|>"), st.characters(codec="utf-8", max_codepoint=0x2fff,
       categories=("Lu", "Ll", "Lo", "Nd", "Zs", "Po"))), max_size=60))
def test_equals_library_on_any_text(text):
    tables = bpe.load(PATH)
    ids = tables.encode_batch([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == library(text)


def test_both_ways_of_merging_agree(tables):
    pieces = ["the", "thethe", "aaaaaaa", "ation", "zzxqjv", "ing" * 9]
    raw = "".join(pieces).encode()
    ids, n = tables.merge_all(raw, np.array([len(p) for p in pieces]))
    at = 0
    for p, k in zip(pieces, n.tolist()):
        assert ids[at:at + k].tolist() == tables.merge(p.encode()) == library(p)
        at += k


def test_undecodable_bytes(tables):
    odd = np.array([tables.byte_ids[0xE3], tables.byte_ids[0x41]], "<u4").tobytes()
    assert tables.decode(odd) == LIBRARY.decode([tables.byte_ids[0xE3], tables.byte_ids[0x41]])


def test_a_small_table_of_units_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_UNITS", 3)
    tables = bpe.ByteBpe(PATH)
    texts = ["one two three four five six seven eight " * 3, "one nine"] * 3
    for text in texts:
        assert np.frombuffer(tables.encode_batch([text])[0], "<u4").tolist() == library(text)


def test_columns(spark):
    rows = [(i, t, "x") for i, t in enumerate(EDGES)] + [(None, None, None), (3, "a", "b"), (3, "a", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = df.select("text", bpe.bpe_encode(F.col("text"), PATH).alias("i")).withColumn(
        "back", bpe.bpe_decode(F.col("i"), PATH)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert np.frombuffer(bytes(r["i"]), "<u4").tolist() == library(r["text"] or "")
        assert r["back"] == (r["text"] or "")
    both = df.select("text", bpe.bpe_round_trip(F.col("text"), PATH).alias("b")).collect()
    assert sorted((r["text"] or "", bytes(r["b"]["ids"]), r["b"]["decoded"]) for r in both) == sorted(
        (r["text"] or "", bytes(r["i"]), r["back"]) for r in out)
    assert df.where("false").select(bpe.bpe_encode(F.col("text"), PATH)).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (300, 40)])
def test_token_counts(spark, chunk, overlap):
    texts = EDGES + ["no" * 2000, "ab cd\n" * 500 + "q" * 900 + " tail words " * 50, "x<|endoftext|>" * 200]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(None, None, 1), (None, "a b " * 300, 1), (2, "c d " * 200, 1),
                                                       (2, "c d " * 200, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = token_counts.count_tokens(df, PATH, chunk_chars=chunk, overlap_chars=overlap).collect()
    want = sorted((i if i is not None else -1, len((t or "").encode()), len(library(t or ""))) for i, t, _ in rows)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_tokens"]) for r in out)
    assert got == want


def test_token_counts_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(df, PATH).collect() == []
