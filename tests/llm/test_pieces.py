"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from eventloom.llm import pieces
from eventloom.llm.queries import QUERIES
from tests.compare import SF
from tests.llm import odd

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL, LIBRARY = pieces.PieceModel(PATH), SentencePieceProcessor(model_file=PATH)
NAMES = [LIBRARY.id_to_piece(i).replace("▁", " ") for i in range(259, LIBRARY.vocab_size())]
ODD = ["", " ", "  a  b ", "a\tb\r\nc", "ﬁ①Å é", "▁x", "\x00a", "a​　b\xa0c", "<s></s><unk><0x0A>", "﻿x", "▁▁▁ ▁", " " * 100, "a" * 1000, "us" * 300, "likelike" * 100, "cosCOMUSlayers" * 50, "😀漢字梦个" * 30]


def check(texts):
    ids, offsets = MODEL.encode([t.encode() for t in texts])
    decoded = MODEL.decode(ids, offsets)
    for k, t in enumerate(texts):
        expected = LIBRARY.encode(t)
        assert ids[offsets[k] : offsets[k + 1]].tolist() == expected
        assert decoded[k] == LIBRARY.decode(expected)


def test_odd_texts():
    check(ODD)
    check([])
    check(["", ""])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_any_text(texts):
    check(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(NAMES), st.sampled_from("abelikstuCOM ▁")), max_size=60))
def test_pieces_side_by_side(parts):
    check(["".join(parts)])


def test_long_words():
    """Rounds and the queue give the same, and both what the library gives."""
    rng = random.Random(2)
    for parts in ("ab", "acgt", "etaoinshrdlu", ["us", "lik", "e", "COM"]):
        word = "".join(rng.choices(parts, k=6000))
        symbols = MODEL.of_char[[ord(c) for c in word]]
        by_queue, alive = symbols.copy(), np.ones(len(symbols), bool)
        MODEL._merge_by_queue(by_queue, alive)
        in_rounds, at = MODEL.merge(symbols, np.arange(len(symbols)) == 0)
        assert np.array_equal(by_queue[alive], in_rounds) and np.array_equal(np.flatnonzero(alive), at)
    check(["".join(rng.choices("etaoinshrdlu", k=3 * pieces.LONG_WORD)) + " end", "ab" * pieces.LONG_WORD])


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([0, 1, 2, 259, 28705]), st.integers(3, 258), st.integers(0, 31_999)), max_size=12))
def test_decoding_any_ids(ids):
    assert MODEL.decode(np.array(ids, np.int32), np.array([0, len(ids)])) == [LIBRARY.decode(ids)]


def test_ids_outside_the_vocabulary():
    for i in (-1, 32_000):
        with pytest.raises(ValueError):
            MODEL.decode(np.array([i], np.int32), np.array([0, 1]))


def test_other_columns_and_nulls(spark):
    docs = odd.docs(spark)
    coded = pieces.encode(docs, PATH)
    assert coded.columns == [*docs.columns, "ids"]
    rows = pieces.decode(coded, PATH).collect()
    expected = [LIBRARY.encode(r[1] or "") for r in odd.ROWS]
    assert sorted(map(list, (r.ids for r in rows))) == sorted(expected)
    assert sorted(r.decoded for r in rows) == sorted(map(LIBRARY.decode, expected))
    assert {r.page for r in rows} == {"own page"}
    assert pieces.decode(spark.createDataFrame([(1, None), (2, [])], "decoded long, ids array<int>"), PATH).collect()[0] == (None, "")
    assert pieces.decode(pieces.encode(odd.docs(spark, []), PATH), PATH).count() == 0
    assert pieces.encode(coded, PATH).columns == coded.columns


def test_op11(spark):
    df = pd.read_parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r for r in QUERIES["op11_sentencepiece"](spark, SF).collect()}
    assert len(found) == len(df)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for i, text in zip(df.doc_id, df.text):
        ids = LIBRARY.encode(text or "")
        assert tuple(found[i]) == (i, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids)))
