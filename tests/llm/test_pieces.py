"""Encoding against the library itself, on random and awkward texts."""

import random
import time

import numpy as np
import pytest
import sentencepiece

from sessionlens.llm import pieces
from sessionlens.llm.queries import PIECE_MODEL

from .conftest import needs_model

pytestmark = needs_model
AWKWARD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "\n\tx", "▁", "▁x ▁", "x\x00y", "日本😀", "é é",
    "<s>hi</s><unk>", "<0x41>", "\r\n", "a\xa0b", "a" * 500, "日本" * 200, "ab " * 300,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


@pytest.fixture(scope="module")
def encoder():
    with open(PIECE_MODEL, "rb") as file:
        return pieces.Encoder(pieces.PieceModel(file.read()))


def _random_texts(count):
    dice = random.Random(3)
    parts = [*"abceiorst éñ▁  \n日😀", "ing", "tion", "the ", "  ", "er"]
    return ["".join(dice.choices(parts, k=dice.randrange(60))) for _ in range(count)]


@pytest.mark.parametrize("texts", [AWKWARD, _random_texts(800)], ids=["awkward", "random"])
def test_ids_and_texts_are_those_of_the_library(library, encoder, texts):
    ids, lengths = encoder.encode(texts)
    found = np.split(ids, np.cumsum(lengths)[:-1])
    assert [row.tolist() for row in found] == library.encode(texts)
    assert encoder.model.decode(ids, lengths) == [library.decode(x) for x in library.encode(texts)]


def test_forgetting_words_changes_nothing(library, encoder, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_BYTES", 2000)
    for text in AWKWARD + _random_texts(50):
        ids, _ = encoder.encode([text])
        assert ids.tolist() == library.encode(text)


def test_long_words_are_merged_as_the_library_does(library, encoder):
    dice = random.Random(4)
    words = ["a" * 5000, "日本" * 1500, "".join(dice.choices("abceiorst", k=20_000)), "é😀" * 900]
    texts = [f"x {word} y {word}" for word in words]
    ids, lengths = encoder.encode(texts)
    found = np.split(ids, np.cumsum(lengths)[:-1])
    assert [row.tolist() for row in found] == library.encode(texts)


def test_a_very_long_word_takes_little_time(encoder):
    word = "".join(random.Random(5).choices("abceiorst", k=200_000))
    started = time.process_time()
    encoder.encode([word])
    assert time.process_time() - started < 10


def test_slices_and_columns(docs, library, monkeypatch):
    monkeypatch.setattr(pieces, "SLICE_CHARS", 5)
    rows = docs([None, "a b", "", "a long text", "c"]).withColumnRenamed("source", "IDS")
    made = pieces.encode(rows, PIECE_MODEL, keep=["doc_id", "IDS"])
    assert made.columns == ["doc_id", "ids"]
    expected = [[], *library.encode(["a b", "", "a long text", "c"])]
    assert [r.ids for r in made.orderBy("doc_id").collect()] == expected


def test_frame_with_nulls_and_clashing_columns(docs, library):
    rows = docs([None, "", "a  b", "a  b"]).withColumnRenamed("lang", "ids")
    made = pieces.encode_and_decode(rows, PIECE_MODEL).orderBy("doc_id").collect()
    assert [r.ids for r in made] == [[], [], library.encode("a  b"), library.encode("a  b")]
    assert [r.decoded for r in made] == ["", "", "a  b", "a  b"]
    assert pieces.encode_and_decode(docs([]), PIECE_MODEL).count() == 0
