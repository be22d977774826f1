"""Toxicity scores: boosted trees over dense features, with isotonic calibration.

The features are densities of a lexicon, its nearness to words of the second person,
rates of capitals, punctuation and obfuscated spellings. The lexicon has a fixed list of
insults, and terms learnt from the labels: words and beginnings of words that occur in
toxic documents far more often than in others. A learnt term occurs in at least
`LEAST_TOXIC_SHARE` of the toxic documents of its sample, so there are at most (mean
number of terms of a document) / `LEAST_TOXIC_SHARE` of them; that bounds the broadcast.

Three separate parts of a bounded sample of labelled documents serve the lexicon, the
trees and the calibration, so that none is fitted to what another has memorised.

Defined cases: a null text is empty; an empty text has zero features and a score; if the
sample holds labels of one value only, every score is the share of toxic labels.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.llm.labelled import sample
from sessionlens.llm.staging import stage
from sessionlens.llm.texts import (
    code_points,
    id_remainder,
    set_aside,
    starts_of,
    text_slices,
    with_batch_columns,
)

#: Labelled documents that are learnt from, at most.
SAMPLE_DOCS = 20_000
LEXICON_PARTS, TREE_PARTS, CALIBRATION_PARTS = (1, 2), (3,), (4,)
LEAST_TOXIC_SHARE, LEAST_TOXIC_DOCS, LEAST_GAIN = 0.005, 4, 9.0
PREFIXES = (4, 5, 6)
TREES, DEPTH, SEED = 20, 3, 7
NEAR_CHARS, WINDOW_CHARS = 40.0, 300
REJECT = 0.5

INSULTS = (
    "asshole", "bastard", "bitch", "clown", "coward", "creep", "cretin", "cunt", "degenerate",
    "dickhead", "disgusting", "dumb", "dumbass", "filth", "fool", "garbage", "idiot", "idiotic",
    "imbecile", "jerk", "loser", "moron", "pathetic", "pig", "prick", "retard", "scum", "slut",
    "stupid", "trash", "ugly", "vermin", "whore", "worthless",
)
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "euch", "tu",
    "toi", "ton", "votre", "vous", "tú", "ti", "usted", "ustedes", "vosotros",
)
_UNLEET = str.maketrans("013457@$", "oieastas")
_MARK_FOR_I = re.compile(r"[!|](?=[^\W\d_])")

FEATURES = (
    "hits", "weight", "distinct", "evidence", "dense", "insults", "near_you", "you", "capitals",
    "shouted", "marks", "calls", "obfuscated", "stretched", "hidden", "log_words",
)


def _terms(text: Column) -> Column:
    """Words (ending in a space) and beginnings of words of a text."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+"))

    def begins(length: int) -> Column:
        longer = F.filter(words, lambda w: F.length(w) > length)
        return F.transform(longer, lambda w: F.substring(w, 1, length))

    whole = F.transform(F.filter(words, lambda w: F.length(w) > 2), lambda w: F.concat(w, F.lit(" ")))
    return F.array_distinct(F.concat(whole, *[begins(n) for n in PREFIXES]))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Term -> log odds of the toxic label, from rows (text, label)."""
    totals = rows.agg(F.sum("label").alias("t"), F.count("*").alias("n")).first()
    toxic, n_docs = totals["t"] or 0, totals["n"]
    clean = n_docs - toxic
    if not toxic or not clean:
        return {}
    counted = (
        rows.select("label", F.explode_outer(_terms(F.col("text"))).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.sum("label").alias("t"), F.count("*").alias("n"))
        .filter(F.col("t") >= max(LEAST_TOXIC_DOCS, math.ceil(LEAST_TOXIC_SHARE * toxic)))
    )
    t, n, share = F.col("t"), F.col("n"), toxic / n_docs
    c = n - t
    gain = t * F.ln(t / (n * share)) + F.when(c > 0, c * F.ln(c / (n * (1 - share)))).otherwise(0.0)
    odds = F.ln((t + 0.5) / (toxic + 1.0)) - F.ln((c + 0.5) / (clean + 1.0))
    found = counted.filter((gain >= LEAST_GAIN) & (odds > math.log(4))).select("term", odds.alias("o"))
    return {row["term"]: row["o"] for row in found.collect()}


class Lexicon:
    """Finds terms at word starts in one pass over a lower-cased text."""

    def __init__(self, learnt: dict[str, float]):
        self.terms: dict[str, list[tuple]] = {}
        for term in SECOND_PERSON:
            self._add(term, ("you", True, 0.0))
        for term in INSULTS:
            self._add(term, ("insult", True, learnt.get(term + " ", 3.0)))
        for term, odds in learnt.items():
            whole = term.endswith(" ")
            if not (whole and term[:-1] in INSULTS):
                self._add(term.rstrip(), ("learnt", whole, odds))
        self.automaton = ahocorasick.Automaton()
        for term, entries in self.terms.items():
            self.automaton.add_word(term, (len(term), term, entries))
        self.automaton.make_automaton()

    def _add(self, term: str, entry: tuple) -> None:
        self.terms.setdefault(term, []).append(entry)

    def find(self, text: str) -> list[tuple[int, str, str, float]]:
        """(position, kind, term, weight) of every find."""
        found = []
        for end, (size, term, entries) in self.automaton.iter(text):
            start = end - size + 1
            if start and text[start - 1].isalpha():
                continue
            follows = text[end + 1:end + 2].isalpha()
            for kind, whole, weight in entries:
                if not (whole and follows):
                    found.append((start, kind, term, weight))
        return found


_UPPER, _LETTER, _DIGIT, _SIGN, _MARK, _CALL, _SPACE = (1 << k for k in range(7))


def _class_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x3100):
        char = chr(point)
        kind = unicodedata.category(char)
        table[point] = (
            _UPPER * (kind in ("Lu", "Lt"))
            | _LETTER * (kind[0] == "L")
            | _DIGIT * (kind == "Nd")
            | _SIGN * (char in "@$*#!|")
            | _MARK * (kind[0] in "PS")
            | _CALL * (char in "!?")
            | _SPACE * char.isspace()
        )
    table[0x3100:] = _LETTER
    return table


_tables: dict[str, np.ndarray] = {}


def _classes(points: np.ndarray) -> np.ndarray:
    if "classes" not in _tables:
        _tables["classes"] = _class_table()
    return _tables["classes"][points]


def _surface(texts: list[str]) -> np.ndarray:
    """Per text: letters, capitals, shouted words, marks, calls, obfuscated and
    stretched places, words, characters."""
    flat, lengths = code_points([text + "\n" for text in texts])
    kinds = _classes(flat)
    is_letter, is_upper = (kinds & _LETTER) > 0, (kinds & _UPPER) > 0
    odd = (kinds & (_DIGIT | _SIGN)) > 0
    space = (kinds & _SPACE) > 0
    first = ~space
    first[1:] &= space[:-1]
    inside = np.zeros(len(flat), bool)
    inside[1:-1] = odd[1:-1] & is_letter[:-2] & is_letter[2:]
    same = np.zeros(len(flat), bool)
    same[2:] = is_letter[2:] & (flat[2:] == flat[1:-1]) & (flat[1:-1] == flat[:-2])
    shout = np.zeros(len(flat), bool)
    shout[:-2] = first[:-2] & is_upper[:-2] & is_upper[1:-1] & is_upper[2:]
    columns = (
        is_letter, is_upper, shout, (kinds & _MARK) > 0, (kinds & _CALL) > 0, inside, same, first,
    )
    begins = starts_of(lengths)[:-1]
    sums = [np.add.reduceat(c, begins, dtype=np.int64) for c in columns]
    return np.stack(sums + [lengths - 1], axis=1).astype(float)


def _found_features(found: list[tuple], words: float) -> list[float]:
    hits = [f for f in found if f[1] != "you"]
    yous = sorted(f[0] for f in found if f[1] == "you")
    weights: dict[str, float] = {}
    near, dense = 0.0, 0
    places = sorted(f[0] for f in hits)
    for i, place in enumerate(places):
        dense = max(dense, i + 1 - bisect_left(places, place - WINDOW_CHARS))
    for place, _, term, weight in hits:
        weights[term] = weight
        at = bisect_left(yous, place)
        gaps = [abs(place - y) for y in yous[max(0, at - 1):at + 1]]
        if gaps:
            near = max(near, math.exp(-min(gaps) / NEAR_CHARS))
    scale = words + 10.0
    return [
        len(hits) / scale,
        sum(f[3] for f in hits) / scale,
        float(len(weights)),
        sum(weights.values()),
        float(dense),
        sum(f[1] == "insult" for f in hits) / scale,
        near,
        len(yous) / scale,
    ]


def features(texts: list[str], lexicon: Lexicon) -> np.ndarray:
    """Rows of `FEATURES` for non-null texts."""
    if not texts:
        return np.empty((0, len(FEATURES)))
    rows = []
    for text, surface in zip(texts, _surface(texts).tolist()):
        letters, upper, shout, marks, calls, inside, same, words, chars = surface
        lower = text.lower()
        found = lexicon.find(lower)
        hidden = 0
        if inside:
            plain = sum(f[1] != "you" for f in found)
            shown = _MARK_FOR_I.sub("i", lower).translate(_UNLEET)
            hidden = sum(f[1] != "you" for f in lexicon.find(shown)) - plain
        scale, chars = words + 10.0, chars + 10.0
        rows.append(
            _found_features(found, words)
            + [
                upper / (letters + 10.0), shout / scale, marks / chars, calls / chars,
                inside / scale, same / scale, max(hidden, 0) / scale, math.log1p(words),
            ]
        )
    return np.array(rows)


def with_features(docs: DataFrame, learnt: dict[str, float], column: str) -> DataFrame:
    """`docs` with the array of features in `column`."""
    shared = docs.sparkSession.sparkContext.broadcast(learnt)

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        lexicon = Lexicon(shared.value)
        made = [features(texts, lexicon) for _, texts in text_slices(batch, "text")]
        flat = np.concatenate(made or [np.empty((0, len(FEATURES)))])
        offsets = np.arange(len(flat) + 1, dtype=np.int32) * len(FEATURES)
        return {column: pa.ListArray.from_arrays(offsets, flat.ravel())}

    field = T.StructField(column, T.ArrayType(T.DoubleType(), True), True)
    return with_batch_columns(docs, compute, [field])


#: Columns that `ToxicityModel.score` adds for a while.
_OWN = ("_features", "_vector", "_raw", "_probability", "_prediction", "_p", "_calibrated")


class ToxicityModel:
    """Lexicon, trees and calibration; `score` adds a column between 0 and 1."""

    def __init__(self, learnt: dict[str, float], trees, calibration, share: float):
        self.learnt, self.trees, self.calibration, self.share = learnt, trees, calibration, share

    def score(self, docs: DataFrame, column: str = "score") -> DataFrame:
        if self.trees is None:
            return docs.withColumn(column, F.lit(self.share))
        docs, back = set_aside(docs, _OWN)
        made = with_features(docs, self.learnt, "_features")
        made = made.withColumn("_vector", array_to_vector("_features")).drop("_features")
        scored = self.trees.transform(made).withColumn("_p", vector_to_array("_probability")[1])
        if self.calibration is not None:
            scored = self.calibration.transform(scored).withColumn("_p", F.col("_calibrated"))
        names = [c for c in docs.columns if c != column]
        bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_p")))
        return scored.select(*names, bounded.alias(column)).withColumnsRenamed(back)


def _both(rows: DataFrame) -> bool:
    return rows.select("label").distinct().count() == 2


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> ToxicityModel:
    """Learns from labelled documents whose crc32(doc_id) is not divisible by 5."""
    rows = stage(sample(docs, labels, "toxic", id_remainder(5) != 0, most), "toxic-sample")

    def part(numbers: tuple[int, ...]) -> Callable[[DataFrame], DataFrame]:
        return lambda frame: frame.filter(F.col("part").isin(*numbers))

    learnt = learn_lexicon(part(LEXICON_PARTS)(rows))
    share = rows.agg(F.avg("label")).first()[0] or 0.0
    rest = rows.filter(F.col("part").isin(*TREE_PARTS, *CALIBRATION_PARTS))
    described = stage(
        with_features(rest, learnt, "_features")
        .withColumn("_vector", array_to_vector("_features"))
        .select("label", "part", F.col("_vector")),
        "toxic-features",
    )
    trained = part(TREE_PARTS)(described)
    if not _both(trained):
        return ToxicityModel(learnt, None, None, share)
    booster = GBTClassifier(
        featuresCol="_vector", labelCol="label", predictionCol="_prediction",
        maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED,
    )
    booster = booster.setRawPredictionCol("_raw").setProbabilityCol("_probability")
    trees = booster.fit(trained.coalesce(4))
    held = part(CALIBRATION_PARTS)(described)
    calibration = None
    if _both(held):
        scored = trees.transform(held).withColumn("_p", vector_to_array("_probability")[1])
        calibration = IsotonicRegression(
            featuresCol="_p", labelCol="label", predictionCol="_calibrated"
        ).fit(scored.select("_p", F.col("label").cast("double").alias("label")))
    return ToxicityModel(learnt, trees, calibration, share)
