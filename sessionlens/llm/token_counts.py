"""Token counts of byte-level BPE with a shortcut for whole tokens.

A text is cut at the special strings of the tokenizer, what is between them into pre-tokens by
the tokenizer's pattern. When the model is read it is proved once, by merging each, which
strings of the vocabulary encode alone as one token. A pre-token that is one of them counts
one, without merging. Only the others are merged, and a worker remembers their counts.

Merging joins the pair of least rank, of equal ones the leftmost, until no pair of the
vocabulary is left; a heap holds the pairs, so a pre-token of n bytes takes n log n steps.

Python's classes of letters and digits are newer than the library's. Characters that are not
assigned in `unicodedata` but letters or digits in the pattern are therefore probed with the
library when the model is read; texts that hold one of those that differ are cut by a pattern
that leaves them out.

Defined cases: a null text counts as the empty text: no bytes, no tokens; special strings
inside a text are one token each; repeated rows give repeated results; input columns that have the name
of a new column, in any case of letters, give way. Texts are read whole; the longest one bounds
the memory of a task.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from sessionlens.llm.texts import text_or_empty, text_slices, with_batch_columns

#: Fixed value: the pattern of byte-level pre-tokens; LETTER and DIGIT stand for classes.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?LETTER+| ?DIGIT+| ?[^\sLETTERDIGIT]+|\s+(?!\S)|\s+"
)
#: Counts of merged pre-tokens that a worker remembers, and the longest of these.
REMEMBERED, REMEMBERED_CHARS = 400_000, 64
#: Pre-tokens of longer texts are not listed all at once.
LISTED_CHARS = 1_000_000
LIMIT = 1024


class Definition(NamedTuple):
    """What workers need: byte symbols, {(left, right): (rank, merged)}, strings that are one
    token, special strings, and characters that the pattern must not take for letters or digits."""

    byte_symbols: list[int]
    merges: dict[tuple[int, int], tuple[int, int]]
    whole: frozenset[str]
    special: tuple[str, ...]
    strange: str


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself where it prints, else one from 256 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printing]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}


def n_tokens_of(word: bytes, byte_symbols: list[int], merges: dict) -> int:
    """Number of symbols that are left when all pairs of `word` are merged."""
    symbols = [byte_symbols[b] for b in word]
    left = len(symbols)
    following = [*range(1, left), -1]
    before = [*range(-1, left - 1)]
    heap = [
        (*found, at)
        for at, pair in enumerate(zip(symbols, symbols[1:]))
        if (found := merges.get(pair))
    ]
    heap = [(rank, at, merged) for rank, merged, at in heap]
    heapq.heapify(heap)
    while heap:
        _, at, merged = heapq.heappop(heap)
        after = following[at]
        # A pair that has changed since makes another symbol, or none.
        found = merges.get((symbols[at], symbols[after])) if after >= 0 else None
        if found is None or found[1] != merged:
            continue
        symbols[at], symbols[after] = merged, -1
        left -= 1
        following[at] = following[after]
        following[after] = -1
        if following[at] >= 0:
            before[following[at]] = at
        for start in (before[at], at):
            if start >= 0 and following[start] >= 0:
                new = merges.get((symbols[start], symbols[following[start]]))
                if new:
                    heapq.heappush(heap, (new[0], start, new[1]))
    return left


def _differing(tokenizer: Tokenizer) -> str:
    """Letters and digits of the pattern that the library takes for neither."""
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    newer = (chr(p) for p in range(0x80, 0x110000) if unicodedata.category(chr(p)) == "Cn")
    taken = regex.findall(r"[\p{L}\p{N}]", "".join(newer))
    return "".join(c for c in taken if len(split("a" + c)) > 1 and len(split("1" + c)) > 1)


def read_definition(path: str) -> Definition:
    """The byte-level BPE of a tokenizer file; other kinds are refused."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    parts = json.loads(text)
    model, cutter = parts["model"], parts["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and parts["normalizer"] is None
        and cutter.get("type") == "ByteLevel"
        and cutter.get("use_regex", True)
        and not cutter["add_prefix_space"]
        and not any(
            model.get(k)
            for k in ("dropout", "unk_token", "continuing_subword_prefix",
                      "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        and not any(t[k] for t in parts["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
    )
    if not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE")
    vocabulary, letters = model["vocab"], byte_letters()
    byte_symbols = [0] * 256
    for letter, byte in letters.items():
        byte_symbols[byte] = vocabulary[letter]
    merges: dict[tuple[int, int], tuple[int, int]] = {}
    for rank, pair in enumerate(model["merges"]):
        first, second = pair.split(" ") if isinstance(pair, str) else pair
        merges[vocabulary[first], vocabulary[second]] = (rank, vocabulary[first + second])
    whole = set()
    for name in vocabulary:
        spelt = bytes(letters[c] for c in name if c in letters)
        # Strings that begin or end inside a character are no pre-tokens.
        if len(spelt) == len(name) and spelt == spelt.decode("utf-8", "ignore").encode():
            if n_tokens_of(spelt, byte_symbols, merges) == 1:
                whole.add(spelt.decode())
    special = tuple(t["content"] for t in parts["added_tokens"])
    strange = _differing(Tokenizer.from_str(text))
    return Definition(byte_symbols, merges, frozenset(whole), special, strange)


def _ranges(characters: str) -> str:
    """The characters as ranges of a regular expression's set."""
    points = sorted(map(ord, characters))
    starts = [p for p, last in zip(points, [-2, *points]) if p != last + 1]
    ends = [p for p, follower in zip(points, [*points[1:], -2]) if p + 1 != follower]
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(starts, ends))


def pre_token_pattern(strange: str = "") -> regex.Pattern:
    """The pattern of pre-tokens, with `strange` characters being neither letter nor digit."""
    if not strange:
        text = PATTERN.replace(r"[^\sLETTERDIGIT]", r"[^\s\p{L}\p{N}]")
        return regex.compile(text.replace("LETTER", r"\p{L}").replace("DIGIT", r"\p{N}"))
    listed = f"[{_ranges(strange)}]"
    text = PATTERN.replace(
        r"[^\sLETTERDIGIT]", rf"(?:[^\s\p{{L}}\p{{N}}]|{listed})"
    )
    text = text.replace("LETTER", rf"(?:(?!{listed})\p{{L}})")
    return regex.compile(text.replace("DIGIT", rf"(?:(?!{listed})\p{{N}})"))


class Counter(dict):
    """Pre-token -> number of its tokens; unknown ones are merged when they are asked for."""

    def __init__(self, definition: Definition):
        super().__init__(dict.fromkeys(definition.whole, 1))
        self.definition, self.learnt = definition, 0
        longest_first = sorted(definition.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")
        self.plain = pre_token_pattern()
        self.exact = pre_token_pattern(definition.strange)
        self.strange = frozenset(definition.strange)

    def __missing__(self, word: str) -> int:
        found = n_tokens_of(word.encode(), self.definition.byte_symbols, self.definition.merges)
        if len(word) <= REMEMBERED_CHARS:
            if self.learnt >= REMEMBERED:
                self.clear()
                self.update(dict.fromkeys(self.definition.whole, 1))
                self.learnt = 0
            self[word] = found
            self.learnt += 1
        return found

    def count(self, text: str) -> int:
        parts = self.special.split(text)
        total = len(parts) - 1
        usual = text.isascii() or self.strange.isdisjoint(text)
        pattern = self.plain if usual else self.exact
        for part in parts:
            if len(part) <= LISTED_CHARS:
                words = pattern.findall(part)
            else:
                words = (match.group() for match in pattern.finditer(part))
            total += sum(map(self.__getitem__, words))
        return total


_counters: dict[int, Counter] = {}


def _counter(shared) -> Counter:
    """The counter of a worker process; it outlives the task, its size is bounded."""
    key = hash((shared.value.special, len(shared.value.merges), shared.value.whole))
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(shared.value)
    return _counters[key]


def with_token_counts(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    keep: list[str] | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """`docs` (or its columns `keep`) with n_bytes (of UTF-8), n_tokens, and over_limit: whether
    these are more than `limit`.

    `tokenizer` is the path of a byte-level BPE file; it is read on the driver, and its
    vocabulary, which does not depend on the data, is sent to the executors.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_definition(tokenizer))
    made = ("n_bytes", "n_tokens", "over_limit")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    read = "_text"
    while read in {c.lower() for c in kept}:
        read = f"_{read}"

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        counter = _counter(shared)
        counts = [
            counter.count(value) for _, texts in text_slices(batch, read) for value in texts
        ]
        return {"n_tokens": pa.array(counts, pa.int64())}

    size = F.octet_length(text_or_empty(text)).cast("long")
    named = docs.select(*kept, size.alias("n_bytes"), F.col(text).alias(read))
    fields = [T.StructField("n_tokens", T.LongType(), True)]
    counted = with_batch_columns(named, compute, fields, [*kept, "n_bytes"])
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
