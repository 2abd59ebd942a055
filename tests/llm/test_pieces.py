import hashlib
import random

import numpy as np
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from motefield.llm import pieces

SF = "/root/testdata/sf0.001/documents.parquet"
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.VOCABULARY)
ODD = ["a", "b", "e", "t", "h", " ", "   ", "▁", "é", "漢", "\n", "\t", "\x00", "😀", "ing", "the", "1", "0", "'", "́", "ß", "<s>", "<0x0A>", "﻿"]


def decoded(ids):
    return pieces.decoded_texts(pa.array([ids], pa.list_(pa.int32())), pieces.vocabulary(pieces.VOCABULARY))[0]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(ODD), max_size=30).map("".join)))
def test_encoding_is_that_of_the_library(text):
    ids = LIBRARY.encode(text)
    assert pieces.vocabulary(pieces.VOCABULARY).encode_text(text) == ids
    assert decoded(ids) == LIBRARY.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=10))
def test_any_ids_decode_as_in_the_library(ids):
    assert decoded(ids) == LIBRARY.decode(ids)


def test_long_words_and_neighbours():
    v, rng = pieces.vocabulary(pieces.VOCABULARY), random.Random(3)
    for word in ["a" * 30000, " " * 5001 + "x", "漢字" * 9000, "aaaaaab" * 3000, "".join(rng.choice("abest") for _ in range(20000))]:
        assert v.encode_text(word) == LIBRARY.encode(word)
    usual = sorted(v.piece)
    for _ in range(4000):
        left, right = rng.choice(usual), rng.choice(usual)
        if v.merged(left)[0] == [left] and v.merged(right)[0] == [right]:
            assert v.compatible(left, right) == (v.merged(left + right)[0] == [left, right]), (left, right)


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    monkeypatch.setattr(pieces, "MOST_PAIRS", 7)
    v, text = pieces.Vocabulary(pieces.VOCABULARY), "some words that are met again and again some words " * 3
    assert v.encode_text(text) == LIBRARY.encode(text)
    assert len(v._known) <= 5 and len(v._pairs) <= 7


def test_whole_table(spark):
    docs = spark.read.parquet(SF)
    got = {r.doc_id: r for r in pieces.codec_digest(docs).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = LIBRARY.encode(r.text or "")
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids)))


def test_odd_tables(spark):
    rows = [(1, None, 5, "x"), (1, "", 5, "x"), (None, "two words", 5, "x"), (2, "two words", None, "x"), (2, "two words", None, "x"), (3, "w" * 200000, 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    out = pieces.decode(pieces.encode(df))
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    got = sorted((r.text or "", r.decoded, len(r.ids)) for r in out.collect())
    assert got == sorted((t or "", t or "", len(LIBRARY.encode(t or ""))) for _, t, *_ in rows)
    assert pieces.codec_digest(df.limit(0)).count() == 0 and pieces.codec_digest(df).count() == 6
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in pieces.decode(nulls).orderBy("ids").collect()] == [None, ""]
    assert np.array_equal(pieces.vocabulary(pieces.VOCABULARY).special.nonzero()[0], [1, 2])


def test_packed_ids_are_those_of_the_library():
    """op12: remembered words are put together as bytes; the second pass takes them all from memory."""
    v = pieces.Vocabulary(pieces.VOCABULARY)
    for text in 2 * ["", None, " ", "the house  of \u4e16 the house", "x" * 200 + " \u2581y", "\U0001F600 ok"]:
        ids = LIBRARY.encode(text or "")
        assert v.encode_packed(text) == b"".join(i.to_bytes(4, "little") for i in ids) and v.encode_text(text) == ids


def test_words_are_cut_where_no_piece_crosses():
    """op12: letters and other characters of a word are remembered apart, with the ids of the library."""
    import sentencepiece
    v = pieces.vocabulary(pieces.VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.VOCABULARY)
    assert v.words.findall(" word, word.  x1_y\n") == [" word", ",", " word", ".", "  x", "1_", "y", "\n"]
    texts = ["word, word. (word) don't x1_y2 áb हिन्दी 50% ½²m  end ", " ,a ", "1sté.\t\n b▁c,", "\U0001f600aあb1", "_a_", "  "]
    for text in texts:
        assert "".join(v.words.findall(" " + text)) == " " + text
        assert v.encode_text(text) == model.encode(text)
