"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE_WORDS` words; only the document has a label.
Every passage is encoded, a gated attention (tanh times sigmoid) learnt together with the
encoder weighs the passages of a document, and the weighted sum is scored. The model is
fitted on a bounded sample of labelled documents and applied to whole texts.

Defined cases: a null or empty text is one passage without words and has a score; if the
sample holds labels of one value only, every score is the share of good labels; repeated
rows have equal scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.llm.labelled import sample
from sessionlens.llm.texts import (
    id_remainder,
    mixed,
    slices,
    starts_of,
    text_slices,
    with_batch_columns,
)
from sessionlens.llm.words import utf8, word_hashes

PASSAGE_WORDS = 64
#: Labelled documents that are learnt from, at most.
SAMPLE_DOCS = 6000
ENCODED, GATE = 16, 8
STEPS, RATE, DECAY, SEED = 300, 0.02, 1e-4, 11
GOOD = 0.3
FEATURES = 13


def _byte_classes() -> np.ndarray:
    table = np.zeros((256, 6), bool)
    for byte in range(256):
        char = chr(byte)
        upper, lower = "A" <= char <= "Z", "a" <= char <= "z" or byte >= 0x80
        table[byte] = (
            upper, upper or lower, char in "#*$%&|<>", char in "!?",
            char.isascii() and char in ".,;:'\"()-", "0" <= char <= "9",
        )
    return table


_CLASSES = _byte_classes()
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, text by text, and the number of passages of each."""
    hashes, n_words = word_hashes(texts)
    n_passages = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    first_passage = starts_of(n_passages)
    flat, text_starts = utf8(texts)
    letter = ~_SPACES[flat]
    begins_word = letter.copy()
    begins_word[1:] &= ~letter[:-1]
    text_of_word = np.repeat(np.arange(len(texts)), n_words)
    within = np.arange(len(hashes)) - np.repeat(starts_of(n_words)[:-1], n_words)
    word_passage = first_passage[text_of_word] + within // PASSAGE_WORDS
    total = int(first_passage[-1])
    # A passage's bytes reach to the first word of the next one.
    starts = text_starts[:-1].repeat(n_passages)
    opening = within % PASSAGE_WORDS == 0
    later = opening & (within > 0)
    starts[word_passage[later]] = np.flatnonzero(begins_word)[later]
    words = np.bincount(word_passage, minlength=total).astype(float)
    sizes = np.diff(np.append(starts, len(flat))).astype(float)
    classes = [
        np.add.reduceat(_CLASSES[flat, k], starts, dtype=np.int64).astype(float)
        for k in range(_CLASSES.shape[1])
    ]
    upper, letters, signs, calls, marks, digits = classes
    solid = np.add.reduceat(letter, starts, dtype=np.int64)
    lines = np.add.reduceat(flat == 10, starts, dtype=np.int64)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (word_passage[1:] == word_passage[:-1])
    repeats = np.bincount(word_passage[again], minlength=total)
    key = np.unique(mixed(hashes ^ mixed(word_passage)), return_index=True)[1]
    distinct = np.bincount(word_passage[key], minlength=total)
    ends_word = letter.copy()
    ends_word[:-1] &= ~letter[1:]
    tail = _CLASSES[flat[np.flatnonzero(ends_word)], 2]
    signed = np.bincount(word_passage[tail], minlength=total)
    scale, chars = words + 1.0, sizes + 1.0
    rows = np.stack(
        [
            upper / (letters + 1), signs / chars, calls / chars, marks / chars, digits / chars,
            solid / scale, repeats / scale, distinct / scale, signed / scale, lines / scale,
            letters / chars, np.log1p(words), np.log1p(n_words).repeat(n_passages),
        ],
        axis=1,
    )
    return rows, n_passages


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


class AttentionModel:
    """Encoder, gated attention and classifier, as numpy arrays."""

    def __init__(self, rows: np.ndarray):
        dice = np.random.default_rng(SEED)
        self.mean, self.spread = rows.mean(axis=0), rows.std(axis=0) + 1e-6

        def start(*shape: int) -> np.ndarray:
            return dice.normal(0, 1 / np.sqrt(shape[0]), shape)

        self.weights = {
            "W": start(rows.shape[1], ENCODED), "b": np.zeros(ENCODED),
            "V": start(ENCODED, GATE), "U": start(ENCODED, GATE), "w": start(GATE),
            "c": start(ENCODED), "d": np.zeros(1),
        }

    def forward(self, rows: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        p, s = self.weights, {}
        starts = starts_of(counts)[:-1]
        s["x"] = np.clip((rows - self.mean) / self.spread, -8, 8)
        s["h"] = np.tanh(s["x"] @ p["W"] + p["b"])
        s["t"] = np.tanh(s["h"] @ p["V"])
        s["g"] = 1 / (1 + np.exp(-(s["h"] @ p["U"])))
        raw = (s["t"] * s["g"]) @ p["w"]
        raw = np.exp(raw - np.maximum.reduceat(raw, starts).repeat(counts))
        s["a"] = raw / _sums(raw, starts).repeat(counts)
        s["z"] = _sums(s["a"][:, None] * s["h"], starts)
        s["p"] = 1 / (1 + np.exp(-np.clip(s["z"] @ p["c"] + p["d"], -30, 30)))
        return s

    def _slopes(self, rows, counts, labels) -> dict[str, np.ndarray]:
        p, s = self.weights, self.forward(rows, counts)
        starts = starts_of(counts)[:-1]
        error = (s["p"] - labels) / len(labels)
        up = np.outer(error, p["c"]).repeat(counts, axis=0)
        by_weight = (up * s["h"]).sum(axis=1)
        mean = _sums(s["a"] * by_weight, starts).repeat(counts)
        raw = s["a"] * (by_weight - mean)
        gate = raw[:, None] * p["w"]
        dt = gate * s["g"] * (1 - s["t"] ** 2)
        dg = gate * s["t"] * s["g"] * (1 - s["g"])
        dh = up * s["a"][:, None] + dt @ p["V"].T + dg @ p["U"].T
        dx = dh * (1 - s["h"] ** 2)
        return {
            "W": s["x"].T @ dx, "b": dx.sum(axis=0), "V": s["h"].T @ dt, "U": s["h"].T @ dg,
            "w": (s["t"] * s["g"]).T @ raw, "c": s["z"].T @ error, "d": error.sum(keepdims=True),
        }

    def fit(self, rows: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> AttentionModel:
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, STEPS + 1):
            for k, slope in self._slopes(rows, counts, labels).items():
                slope = slope + DECAY * self.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope**2
                pace = (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8
                )
                self.weights[k] = self.weights[k] - RATE * pace
        return self

    def score(self, texts: list[str]) -> np.ndarray:
        return self.forward(*passages(texts))["p"] if texts else np.empty(0)


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> AttentionModel | float:
    """Learns from documents whose crc32(doc_id) is not divisible by 5.

    Returns the share of good labels where the sample has one value only.
    """
    chosen = sample(docs, labels, "quality", id_remainder(5) != 0, most).select("text", "label")
    found = chosen.toArrow().to_pydict()
    wanted = np.array(found["label"], float)
    if len(set(found["label"])) < 2:
        return float(wanted.mean()) if len(wanted) else 0.0
    rows, counts = [], []
    lengths = np.array([len(text) for text in found["text"]])
    for start, end in slices(lengths):
        some, number = passages(found["text"][start:end])
        rows.append(some)
        counts.append(number)
    bags = np.concatenate(rows)
    return AttentionModel(bags).fit(bags, np.concatenate(counts), wanted)


def score(docs: DataFrame, model: AttentionModel | float, column: str = "score") -> DataFrame:
    """`docs` with the score in `column`."""
    if isinstance(model, float):
        return docs.withColumn(column, F.lit(model))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        scores = [shared.value.score(texts) for _, texts in text_slices(batch, "text")]
        return {column: pa.array(np.concatenate(scores or [np.empty(0)]), pa.float64())}

    return with_batch_columns(docs, compute, [T.StructField(column, T.DoubleType(), True)])
