"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut into words (a run of spaces and what follows it up to the next space);
no piece of the vocabulary crosses such a border, which is checked when the model is
read. All distinct new words of a batch are encoded together: their symbols lie in one
flat array, every round finds the best pair of each word by a segmented minimum of pair
ranks, merges it from the left in all words at once and compacts the array, until no
word has a pair of the vocabulary left.

Within a word the library merges one pair at a time, always the best and of equal ones
the leftmost. Merging all occurrences of the best pair in one round gives the same
result unless the merged piece takes part in a pair of better rank; for such pieces,
and for ranks that several pieces share, only the leftmost occurrence is merged.

Very long words would need as many rounds as they have pieces that are merged one at a time;
a heap of pairs merges these words, in the same order.

Defined cases: a null text is encoded as the empty text, which has no ids; characters
outside the vocabulary become byte pieces; repeated rows give repeated results; input columns that
have the name of a new column, in any case of letters, give way; an empty table stays empty. Texts
are read whole, and the longest one bounds the memory of a task.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sessionlens.llm.texts import gather_ranges, starts_of, text_slices

SPACE = "▁"
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_NONE = np.iinfo(np.int32).max
#: Memory for the words that a worker remembers before it starts anew, and for each beside its
#: letters and ids.
CACHED_BYTES, WORD_BYTES = 32_000_000, 160
#: Characters that are encoded, and given back, at a time; a longer text is alone.
SLICE_CHARS = 500_000
#: Words of more symbols are merged by a heap.
LONG_WORD = 1000


class PieceModel:
    """Vocabulary of a BPE model with byte fallback, as arrays."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(size)]
        plain = [
            i
            for i in range(size)
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))
        ]
        self.size = size
        self.byte_ids = np.array([names.index(f"<0x{b:02X}>") for b in range(256)])
        symbol_of = {names[i]: i for i in plain}
        for char in sorted({c for i in plain for c in names[i]} - symbol_of.keys()):
            symbol_of[char] = size + ord(char)
        #: A character's symbol: its piece, else a number that stands for the character.
        self.char_symbol = np.arange(size, size + 0x110000, dtype=np.int64)
        for name, symbol in symbol_of.items():
            if len(name) == 1:
                self.char_symbol[ord(name)] = symbol
        scores = np.array([library.get_score(i) for i in range(size)])
        _, rank_of = np.unique(-scores, return_inverse=True)
        longer = [i for i in plain if len(names[i]) > 1]
        by_rank = np.bincount(rank_of[longer], minlength=size)
        lefts, rights, merged = [], [], []
        single = by_rank[rank_of] > 1
        for i in longer:
            for cut in range(1, len(names[i])):
                left, right = symbol_of.get(names[i][:cut]), symbol_of.get(names[i][cut:])
                if left is not None and right is not None:
                    lefts.append(left)
                    rights.append(right)
                    merged.append(i)
                    for part in (left, right):
                        if part < size and rank_of[part] >= rank_of[i]:
                            single[part] = True
        keys = np.array(lefts, np.int64) << 32 | np.array(rights, np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_piece = np.array(merged, np.int64)[order]
        self.pair_rank = rank_of[self.pair_piece].astype(np.int32)
        self.pair_single = single[self.pair_piece]
        #: Whether words can be encoded one by one.
        self.by_word = not any(SPACE in names[i].lstrip(SPACE) for i in plain)
        texts = [names[i].replace(SPACE, " ").encode() for i in range(size)]
        for i in range(size):
            if library.is_control(i):
                texts[i] = b""
            elif library.is_unknown(i):
                texts[i] = library.decode([i]).encode()
            elif library.is_byte(i):
                texts[i] = bytes([int(names[i][1:-1], 16)])
        self.text_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.text_lengths = np.array([len(t) for t in texts], np.int64)
        self.text_starts = starts_of(self.text_lengths)[:-1]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and the number of ids of each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbols, word = self.char_symbol[chars], np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        starts = starts_of(lengths)
        for number in np.flatnonzero(lengths > LONG_WORD):
            merged = self._merge_long(symbols[starts[number]:starts[number + 1]])
            done_symbols.append(merged)
            done_words.append(np.full(len(merged), number))
        short = np.repeat(lengths <= LONG_WORD, lengths)
        symbols, word = symbols[short], word[short]
        at, rank = self._pairs(symbols, word, np.arange(len(symbols)))
        while len(symbols):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.append(first, len(symbols)))
            least = np.repeat(np.minimum.reduceat(rank, first), sizes)
            ended = least == _NONE
            best = np.flatnonzero((rank == least) & ~ended)
            best = best[self._mergeable(best, at, word)]
            symbols[best] = self.pair_piece[at[best]]
            if ended.any():
                done_symbols.append(symbols[ended])
                done_words.append(word[ended])
            keep = ~ended
            keep[best + 1] = False
            place = (np.cumsum(keep) - 1)[best]
            symbols, word, at, rank = symbols[keep], word[keep], at[keep], rank[keep]
            changed = np.concatenate((place, place[place > 0] - 1))
            at[changed], rank[changed] = self._pairs(symbols, word, changed)
        if not done_symbols:
            return np.empty(0, np.int64), lengths * 0
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return self._with_bytes(symbols[order], word[order], len(words))

    def _merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """The symbols of one word, merged: always the best pair, of equal ones the leftmost."""
        pieces, ends = symbols.tolist(), len(symbols)
        following, before = [*range(1, ends), -1], [*range(-1, ends - 1)]
        places = np.arange(ends)
        at, rank = self._pairs(symbols, places * 0, places)
        heap = [
            (r, place, piece)
            for r, place, piece in zip(rank.tolist(), places.tolist(), self.pair_piece[at].tolist())
            if r != _NONE
        ]
        heapq.heapify(heap)
        known = self._long_pairs

        def pair(place: int) -> tuple[int, int] | None:
            return known.get((pieces[place], pieces[following[place]]))

        while heap:
            _, place, piece = heapq.heappop(heap)
            after = following[place]
            if pieces[place] < 0 or after < 0 or (pair(place) or (0, -1))[1] != piece:
                continue  # one of its symbols has been merged since
            pieces[place], pieces[after] = piece, -1
            following[place] = following[after]
            if following[place] >= 0:
                before[following[place]] = place
            for start in (before[place], place):
                if start >= 0 and following[start] >= 0 and (new := pair(start)):
                    heapq.heappush(heap, (new[0], start, new[1]))
        return np.array([symbol for symbol in pieces if symbol >= 0], np.int64)

    @functools.cached_property
    def _long_pairs(self) -> dict[tuple[int, int], tuple[int, int]]:
        """(left, right) -> (rank, piece)."""
        left, right = self.pair_keys >> 32, self.pair_keys & 0xFFFFFFFF
        found = zip(self.pair_rank.tolist(), self.pair_piece.tolist())
        return dict(zip(zip(left.tolist(), right.tolist()), found))

    def _pairs(self, symbols, word, places) -> tuple[np.ndarray, np.ndarray]:
        """Index in the table of pairs, and rank, of the pairs that begin at `places`."""
        follower = np.minimum(places + 1, len(symbols) - 1)
        pair = symbols[places] << 32 | symbols[follower]
        at = np.minimum(np.searchsorted(self.pair_keys, pair), len(self.pair_keys) - 1)
        found = (self.pair_keys[at] == pair) & (word[places] == word[follower])
        found &= follower > places
        return at, np.where(found, self.pair_rank[at], _NONE)

    def _mergeable(self, best: np.ndarray, at: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Which of the best pairs' positions are merged in this round."""
        if not len(best):
            return np.zeros(0, bool)
        leftmost = np.concatenate(([True], word[best][1:] != word[best][:-1]))
        # Overlapping pairs (a a a): every second position of a run of neighbours.
        apart = leftmost | (np.diff(best, prepend=-2) != 1)
        run = np.maximum.accumulate(np.where(apart, np.arange(len(best)), 0))
        second = (np.arange(len(best)) - run) % 2 == 0
        return np.where(self.pair_single[at[best]], leftmost, second)

    def _with_bytes(self, symbols, word, n_words):
        strange = np.flatnonzero(symbols >= self.size)
        counts = np.ones(len(symbols), np.int64)
        spelt = [chr(symbols[i] - self.size).encode() for i in strange]
        counts[strange] = [len(s) for s in spelt]
        ids = np.repeat(symbols, counts)
        if len(strange):
            places = gather_ranges(starts_of(counts)[strange], counts[strange])
            ids[places] = self.byte_ids[np.frombuffer(b"".join(spelt), np.uint8)]
        return ids, np.bincount(np.repeat(word, counts), minlength=n_words)

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
        """Texts of consecutive runs of ids; ill-formed bytes become U+FFFD."""
        size = self.text_lengths[ids]
        flat = self.text_bytes[gather_ranges(self.text_starts[ids], size)].tobytes()
        ends = starts_of(size)[starts_of(lengths)]
        texts = []
        for start, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
            start += flat[start:start + 1] == b" " and end > start
            texts.append(flat[start:end].decode("utf-8", "replace"))
        return texts


class Encoder:
    """Encodes texts word by word and remembers the ids of words it has seen."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.code: dict[str, int] = {}
        self.held = 0
        self.starts, self.lengths = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)

    def _words(self, text: str) -> list[str]:
        """Words without the one space that usually precedes them; others in full."""
        if not text:
            return []
        if not self.model.by_word:
            return [SPACE + SPACE + text.replace(" ", SPACE)]
        if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        words = _WORD.findall(SPACE + text.replace(" ", SPACE))
        return [w[1:] if len(w) > 1 and w[1] != SPACE else SPACE + w for w in words]

    def _learn(self, words: set[str]) -> None:
        new = list(words - self.code.keys())
        if not new:
            return
        size = sum(map(len, new)) * 8 + len(new) * WORD_BYTES
        if self.held and self.held + size > CACHED_BYTES:
            self._forget()
            new = list(words)
            size = sum(map(len, new)) * 8 + len(new) * WORD_BYTES
        self.held += size
        full = [w[1:] if w.startswith(SPACE) else SPACE + w for w in new]
        ids, lengths = self.model.encode_words(full)
        known = len(self.code)
        self.code.update(zip(new, range(known, known + len(new))))
        self.starts = np.concatenate((self.starts, len(self.ids) + starts_of(lengths)[:-1]))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        words = [self._words(text) for text in texts]
        self._learn(set().union(*words))
        n_words = np.fromiter(map(len, words), np.int64, len(words))
        every_word = itertools.chain.from_iterable(words)
        codes = np.fromiter(map(self.code.__getitem__, every_word), np.int64, n_words.sum())
        lengths = self.lengths[codes]
        ids = self.ids[gather_ranges(self.starts[codes], lengths)]
        ends = starts_of(lengths)[starts_of(n_words)]
        return ids, np.diff(ends)


_encoders: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """The encoder of a worker process; it outlives the task, what it remembers is bounded."""
    key = hash(shared.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(PieceModel(shared.value))
    return _encoders[key]


def encode(
    docs: DataFrame,
    model: str,
    text: str = "text",
    keep: list[str] | None = None,
    decode: bool = False,
) -> DataFrame:
    """`docs` with `ids` (array of int) and, with `decode`, `decoded` (the text of these ids).

    `model` is the path of a SentencePiece BPE model with byte fallback, without text
    normalisation. It is read on the driver and sent to the executors; its size is
    that of the vocabulary and does not depend on the data. `keep` names the columns to
    return, all by default. Results are given back slice by slice.
    """
    with open(model, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    new = [T.StructField("ids", T.ArrayType(T.IntegerType(), True), True)]
    if decode:
        new.append(T.StructField("decoded", T.StringType(), True))
    made = {field.name for field in new}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    read = text
    while read.lower() in made | {c.lower() for c in kept if c != text}:
        read = f"_{read}"
    columns = [*kept, *([] if read in kept else [read])]
    schema = T.StructType([docs.schema[c] for c in kept] + new)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            for start, texts in text_slices(batch, read, SLICE_CHARS):
                ids, lengths = encoder.encode(texts)
                part = batch.slice(start, len(texts))
                offsets = starts_of(lengths).astype(np.int32)
                arrays = [part.column(batch.schema.get_field_index(c)) for c in kept]
                arrays.append(pa.ListArray.from_arrays(offsets, ids))
                if decode:
                    arrays.append(pa.array(encoder.model.decode(ids, lengths), pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [array.cast(field.type) for array, field in zip(arrays, arrow)], schema=arrow
                )

    named = docs if read in docs.columns else docs.withColumn(read, F.col(text))
    return named.select(*columns).mapInArrow(run, schema)


def encode_and_decode(
    docs: DataFrame, model: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """`docs` with `ids` and `decoded`."""
    return encode(docs, model, text, keep, decode=True)
