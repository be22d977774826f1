"""Token counts against the tokenizer's own library."""

import random

import pytest
import regex
from tokenizers import Tokenizer

from sessionlens.llm import token_counts
from sessionlens.llm.queries import BYTE_MODEL

from .conftest import SF, needs_model, needs_tables

pytestmark = needs_model


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_MODEL)


@pytest.fixture(scope="module")
def definition():
    return token_counts.read_definition(BYTE_MODEL)


def _expected(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_whole_tokens_are_those_the_library_keeps_whole(library, definition):
    letters = {byte: letter for letter, byte in token_counts.byte_letters().items()}
    some = random.Random(1).sample(sorted(definition.whole), 4000)
    for text in some:
        spelt = "".join(letters[b] for b in text.encode())
        assert len(library.model.tokenize(spelt)) == 1


def test_every_character_falls_where_the_library_puts_it(library, definition):
    counter = token_counts.Counter(definition)
    chars = [chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    # All that is assigned or special to the pattern, and a part of the unassigned rest.
    differing = set(definition.strange)
    some = [c for c in chars if c in differing or ord(c) < 0x3000] + chars[0x3000::97]
    for start in range(0, len(some), 500):
        text = "".join(f"a{c}a 1{c}1 !{c}! {c} " for c in some[start:start + 500])
        pattern = counter.plain if differing.isdisjoint(text) else counter.exact
        split = library.pre_tokenizer.pre_tokenize_str(text)
        assert pattern.findall(text) == [text[a:b] for _, (a, b) in split]


def test_random_texts(library, definition):
    r = random.Random(2)
    alphabet = [chr(p) for p in (*range(0, 0x250), 0x558, 0x208F, 0x3FC3B, 0x85, 0x1C, 0x2028)]
    alphabet += ["<|endoftext|>", "<|endoftext", "'s", "'ll", "  ", "\n\n", " the", "日本語", "😀"]
    texts = ["".join(r.choices(alphabet, k=r.randrange(60))) for _ in range(3000)]
    counter = token_counts.Counter(definition)
    assert [counter.count(t) for t in texts] == _expected(library, texts)


def test_long_words_and_long_texts(library, definition, monkeypatch):
    texts = ["a" * 50_000, "ab" * 30_000, " " * 40_000, "é" * 20_000, "the cat " * 20_000]
    counter = token_counts.Counter(definition)
    assert [counter.count(t) for t in texts] == _expected(library, texts)
    monkeypatch.setattr(token_counts, "LISTED_CHARS", 10)
    assert [counter.count(t) for t in texts] == _expected(library, texts)


def test_a_full_memory_starts_anew(library, definition, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    texts = [f"qzx{i}w vvk{i} xq{i % 3}" for i in range(40)]
    counter = token_counts.Counter(definition)
    assert [counter.count(t) for t in texts] == _expected(library, texts)
    assert len(counter) <= len(definition.whole) + 4


def test_whole_tokens_are_not_merged(definition):
    counter = token_counts.Counter(definition)
    assert counter.count("the cat sat on the mat<|endoftext|> and the dog") == 10
    assert counter.learnt == 0


def test_frame_defined_cases(spark, library):
    rows = [(1, None, 7, "x"), (2, "", 8, "y"), (2, "", 8, "y"), (None, "a<|endoftext|>b é", 9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_Tokens int, _text string")
    made = token_counts.with_token_counts(docs, BYTE_MODEL, limit=3)
    assert made.columns == ["doc_id", "text", "_text", "n_bytes", "n_tokens", "over_limit"]
    found = sorted(((r.doc_id or 0), r.n_bytes, r.n_tokens, r.over_limit) for r in made.collect())
    n = len(library.encode("a<|endoftext|>b é", add_special_tokens=False).ids)
    assert found == [(0, 18, n, n > 3), (1, 0, 0, False), (2, 0, 0, False), (2, 0, 0, False)]
    empty = token_counts.with_token_counts(docs.limit(0), BYTE_MODEL)
    assert empty.count() == 0


@needs_tables
def test_query_counts_every_text(spark, library):
    from sessionlens.llm import queries

    docs = queries.table(spark, SF, "documents").select("doc_id", "text").collect()
    expected = dict(zip((d.doc_id for d in docs), _expected(library, [d.text or "" for d in docs])))
    rows = queries.whole_token_counts(spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == expected and len(rows) == len(docs)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)
    sizes = {d.doc_id: len((d.text or "").encode()) for d in docs}
    assert {r.doc_id: r.n_bytes for r in rows} == sizes


def test_other_tokenizers_are_refused(tmp_path, library):
    other = tmp_path / "other.json"
    text = regex.sub(r'"add_prefix_space":\s*false', '"add_prefix_space": true', library.to_str())
    other.write_text(text, encoding="utf-8")
    with pytest.raises(ValueError):
        token_counts.read_definition(str(other))
