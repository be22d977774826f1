"""Language identification in two steps: the family first, then the language within it.

Both steps vote with linear support vector machines, one for every two classes: between
families, and between the languages of a family. A text is described by the square roots
of the shares of its hashed character n-grams, so that a text and its repetition look
alike. The machines learn from a bounded sample of each language's documents; the
documents of the sample are described where they are read, and only their features
reach the driver.

Defined cases: a text that is null or has no letter is `und` with score 0; languages
that the family table does not name are families of their own; with one learnt language
every text with letters has it; without any, all are `und`, as over an empty table of
documents to learn from; an empty table to name stays empty; repeated rows are alike;
languages with equal counts are learnt in the order of their names; ties of votes go
to the greater sum of margins, then to the first name; columns named lang_pred or score
give way, all others are kept.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.llm.texts import (
    code_points,
    is_letter,
    mixed,
    starts_of,
    text_or_empty,
    text_slices,
    with_batch_columns,
)

UNDETERMINED = "und"
#: Language -> family, for the languages of large corpora.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "yi"),
    "romance": ("fr", "es", "pt", "it", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "ky", "uz", "tt"),
    "indic": ("hi", "bn", "ur", "pa", "mr", "gu", "ne", "si"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "semitic": ("ar", "he", "am", "mt"),
    "sinitic": ("zh", "yue"),
    "malayic": ("id", "ms", "jv", "tl"),
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
#: Documents of each language that are learnt from, about.
SAMPLE_DOCS = 1000
#: Documents of all languages together, about; each is `DIMENSIONS` numbers of four bytes.
SAMPLE_ROWS = 4_000
#: Languages that are learnt: those with the most usable documents.
MOST_LANGUAGES = 32
DIMENSIONS, LONGEST = 4096, 3
_ROWS = 256
STEPS, RIDGE = 200, 1e-4


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang, lang)


def describe(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of features for at most a few hundred texts, and their numbers of letters."""
    flat, lengths = code_points([f" {text.lower()} " for text in texts])
    letter = is_letter(flat)
    begins = starts_of(lengths)
    letters = np.add.reduceat(letter, begins[:-1], dtype=np.int64)
    chars = np.where(letter, flat, 32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), lengths)
    counts = np.zeros(len(texts) * DIMENSIONS)
    rolled = np.zeros(len(chars), np.uint64)
    for size in range(1, LONGEST + 1):
        rolled = rolled[:len(chars) - size + 1] * np.uint64(0x110000) + chars[size - 1:]
        same = row[size - 1:] == row[:len(rolled)]
        cell = (mixed(rolled) >> np.uint64(40)).astype(np.int64) % DIMENSIONS
        cell += row[:len(rolled)] * DIMENSIONS
        counts += np.bincount(cell[same], minlength=len(counts))
    shares = counts.reshape(len(texts), DIMENSIONS)
    shares /= np.maximum(shares.sum(axis=1, keepdims=True), 1)
    return np.sqrt(shares).astype(np.float32), letters


def _described(texts: list[str]):
    for start in range(0, len(texts), _ROWS):
        yield describe(texts[start:start + _ROWS])


def fit_machine(rows: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weights (and offset, last) of a linear machine with squared hinge loss."""
    data = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
    sign = np.where(positive, 1.0, -1.0).astype(np.float32)
    # Both classes count alike, however many rows they have.
    share = np.where(positive, 0.5 / positive.sum(), 0.5 / (~positive).sum())
    weights = ahead = np.zeros(data.shape[1], np.float32)
    pace = 1.0
    for _ in range(STEPS):
        slack = np.maximum(0, 1 - sign * (data @ ahead))
        slope = RIDGE * ahead - 2 * (data.T @ (share * sign * slack).astype(np.float32))
        moved = ahead - slope / 4.0
        faster = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = moved + (pace - 1) / faster * (moved - weights)
        weights, pace = moved, faster
    return weights


class Voters:
    """A machine for every two of a list of classes."""

    def __init__(self, classes: list[str], rows: np.ndarray, labels: np.ndarray):
        self.classes = classes
        self.pairs = list(combinations(range(len(classes)), 2))
        machines = []
        for a, b in self.pairs:
            two = (labels == classes[a]) | (labels == classes[b])
            machines.append(fit_machine(rows[two], labels[two] == classes[a]))
        self.weights = np.stack(machines, axis=1) if machines else None

    def vote(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the chosen class, and a confidence: its weakest duel as a probability."""
        if self.weights is None:
            return np.zeros(len(rows), int), np.ones(len(rows))
        margins = rows @ self.weights[:-1] + self.weights[-1]
        sure = np.full((len(rows), len(self.classes)), np.inf)
        votes = np.zeros(sure.shape)
        for n, (a, b) in enumerate(self.pairs):
            for one, margin in ((a, margins[:, n]), (b, -margins[:, n])):
                sure[:, one] = np.minimum(sure[:, one], margin)
                # A margin counts as a vote and breaks ties of votes.
                votes[:, one] += (margin > 0) + 0.01 * np.tanh(margin)
        chosen = votes.argmax(axis=1)
        weakest = sure[np.arange(len(rows)), chosen]
        return chosen, 1 / (1 + np.exp(-4 * np.clip(weakest, -20, 20)))


class LanguageModel:
    """Voters between families, and between the languages of each family."""

    def __init__(self, rows: np.ndarray, langs: np.ndarray):
        families = np.array([family_of(lang) for lang in langs])
        self.families = Voters(sorted(set(families)), rows, families)
        self.within = [
            Voters(sorted(set(langs[families == f])), rows[families == f], langs[families == f])
            for f in self.families.classes
        ]

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        family, score = self.families.vote(rows)
        langs = np.empty(len(rows), object)
        for number, voters in enumerate(self.within):
            mine = family == number
            if mine.any():
                chosen, sure = voters.vote(rows[mine])
                langs[mine] = np.array(voters.classes, object)[chosen]
                score[mine] *= sure
        return langs.tolist(), score


def training_sample(
    docs: DataFrame,
    usable: Column,
    each: int = SAMPLE_DOCS,
    most_languages: int = MOST_LANGUAGES,
) -> DataFrame:
    """(lang, text) of about `each` documents of every learnt language, by a hash of id and text.

    Only the counts of the languages are shuffled, and at most `most_languages` of them
    reach the driver; texts stay where they are read.
    """
    rows = docs.filter(usable & F.col("lang").isNotNull())
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    learnt = counts.orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    each = min(each, SAMPLE_ROWS / max(len(learnt), 1))
    spread = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    chosen = F.lit(False)
    for row in learnt:
        chosen |= (F.col("lang") == row["lang"]) & (spread * row["n"] < each)
    return rows.filter(chosen).select("lang", text_or_empty().alias("text"))


def described_sample(sample: DataFrame) -> DataFrame:
    """(lang, features) of the texts that have letters, a row of features as bytes."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        made = []
        for _, texts in text_slices(batch, "text"):
            for rows, letters in _described(texts):
                # Texts without letters say nothing about a language.
                made += [row.tobytes() if n else None for row, n in zip(rows, letters)]
        return {"features": pa.array(made, pa.binary())}

    field = T.StructField("features", T.BinaryType(), True)
    described = with_batch_columns(sample, compute, [field], keep=["lang"])
    return described.filter(F.col("features").isNotNull())


def fit(
    docs: DataFrame,
    usable: Column,
    each: int = SAMPLE_DOCS,
    most_languages: int = MOST_LANGUAGES,
) -> LanguageModel | None:
    """Learns on the driver from the bounded sample; None if there is nothing to learn."""
    sample = described_sample(training_sample(docs, usable, each, most_languages))
    table = sample.toArrow()
    if not table.num_rows:
        return None
    rows = np.stack([np.frombuffer(f.as_buffer(), np.float32) for f in table["features"]])
    return LanguageModel(rows, np.array(table["lang"].to_pylist(), object))


def with_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """`docs` with lang_pred and score, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        langs, scores = [], []
        for _, texts in text_slices(batch, "text"):
            for rows, letters in _described(texts):
                found, score = [UNDETERMINED] * len(rows), np.zeros(len(rows))
                if shared.value is not None:
                    found, score = shared.value.predict(rows)
                langs += [f if n else UNDETERMINED for f, n in zip(found, letters)]
                scores.append(np.where(letters > 0, score, 0.0))
        flat = np.concatenate(scores or [np.empty(0)])
        return {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(flat, pa.float64())}

    fields = [
        T.StructField("lang_pred", T.StringType(), True),
        T.StructField("score", T.DoubleType(), True),
    ]
    return with_batch_columns(docs, compute, fields)
