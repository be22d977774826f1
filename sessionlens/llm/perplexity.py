"""Quality rules: base counts of a text, and bands of its n-gram perplexity.

A modified Kneser-Ney model of character n-grams, one for each language of the corpus,
is counted by Spark over all documents: tasks combine their own n-grams first, then the
counts of the highest order are summed by (language, n-gram), and continuation counts,
discounts and interpolated probabilities of all orders follow by grouping and joining.

For scoring, every order is a sorted array of 64-bit hashes of language and n-gram beside an
array of log probabilities, and the same for the weights of contexts: 12 bytes an entry. N-grams
that occur once are left out (see below), so the arrays hold those that the corpus repeats, and
grow with it. They are sent to the executors in passes over the documents, each for some
languages, so that a pass has about `PASS_VALUES` entries; only a single language may exceed
that. Two n-grams of a language share a hash with a probability below 1e-5 at ten million. An
n-gram that the model does not have takes the next lower order times the weight of its context.

The documents that are scored are those that were counted. An n-gram that occurs once
in the corpus occurs in the scored text itself and nowhere else, so it counts as unseen
(leaving one out); else a strange text would be likely after its own model.

A document is rejected when the logarithm of its perplexity lies outside its language's
band: the median, less or more than `WIDTH` times the spread (median absolute deviation).
The band is wider for short texts, whose mean varies more: by the root of
1 + `SHORT_WORDS` / words. Medians are approximate percentiles, aggregated over all documents of a language.

Defined cases: a null text has no words and fails the base rules; documents without a
language share the language ''; a language in which all documents are alike has a band
of at least `LEAST_REACH` on either side; repeated rows count as often as they come.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sessionlens.llm.staging import stage
from sessionlens.llm.texts import (
    code_points,
    mixed,
    starts_of,
    text_slices,
    with_batch_columns,
)
from sessionlens.llm.words import utf8, word_hashes

ORDER = 4
#: Entries of all arrays that are sent to the executors at once, 12 bytes each.
PASS_VALUES = 20_000_000
#: Stands before every text, so that its first characters have a context.
START = "\x02"
WIDTH, LEAST_REACH = 9.0, 0.05
SHORT_WORDS = 100
LEAST_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
#: N-grams that a task keeps before it combines them, and gives them back if that is not enough.
_HELD = 2_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


# --- base counts ---------------------------------------------------------------------

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SIGNS = np.zeros(256, bool)
_SIGNS[[ord(c) for c in "#*$%&|<>"]] = True
_BLANK = " \t\n\x0b\f\r"


def _repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    return len(lines) - len(set(lines))


def _repeated_words(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text: words inside a window of `WINDOW` words that occurs more than once."""
    text = np.repeat(np.arange(len(counts)), counts)
    n = len(hashes) - WINDOW + 1
    if n < 1:
        return np.zeros(len(counts), np.int64)
    rolled = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + hashes[k:k + n]
    whole = np.flatnonzero(text[:n] == text[WINDOW - 1:])
    keys = mixed(mixed(rolled[whole]) ^ mixed(text[whole]))
    _, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = whole[times[inverse] > 1]
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + WINDOW, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(text[covered], minlength=len(counts))


def base_counts(texts: list[str]) -> dict[str, np.ndarray]:
    hashes, n_words = word_hashes(texts)
    flat, starts = utf8(texts)
    first_bytes = ~_SPACES[flat] & ((flat & 0xC0) != 0x80)
    begins = starts[:-1]
    return {
        "n_words": n_words,
        "word_chars": np.add.reduceat(first_bytes, begins, dtype=np.int64),
        "n_symbols": np.add.reduceat(_SIGNS[flat], begins, dtype=np.int64),
        "n_dup_lines": np.fromiter(map(_repeated_lines, texts), np.int64, len(texts)),
        "n_repeat_words": _repeated_words(hashes, n_words),
    }


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)


# --- counting ------------------------------------------------------------------------


def _padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return code_points([START * (ORDER - 1) + text for text in texts])


def _rolled(flat: np.ndarray, size: int) -> np.ndarray:
    """A number for the `size` characters that end at each place (from size - 1 on)."""
    n = max(0, len(flat) - size + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled = rolled * _FACTOR + flat[k:k + n].astype(np.uint64)
    return rolled


class _Counter:
    """N-grams of the highest order of one language, with their counts."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, texts: list[str]) -> None:
        flat, lengths = _padded(texts)
        rolled = _rolled(flat, ORDER)
        inner = np.ones(len(flat), bool)
        for k in range(ORDER - 1):
            inner[starts_of(lengths)[:-1] + k] = False
        ends = np.flatnonzero(inner)
        _, first, counts = np.unique(
            mixed(rolled[ends - ORDER + 1]), return_index=True, return_counts=True
        )
        places = ends[first][:, None] - np.arange(ORDER - 1, -1, -1)
        self.parts.append((rolled[ends[first] - ORDER + 1], flat[places], counts))

    def held(self) -> int:
        return sum(len(p[0]) for p in self.parts)

    def combine(self) -> None:
        names, grams, counts = (np.concatenate(x) for x in zip(*self.parts))
        _, first, inverse = np.unique(mixed(names), return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=counts).astype(np.int64)
        self.parts = [(names[first], grams[first], total)]

    def rows(self) -> tuple[list[str], np.ndarray]:
        self.combine()
        _, grams, counts = self.parts[0]
        text = grams.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        return [text[i:i + ORDER] for i in range(0, len(text), ORDER)], counts


_COUNTS = T.StructType(
    [
        T.StructField("lang", T.StringType(), True),
        T.StructField("gram", T.StringType(), True),
        T.StructField("n", T.LongType(), True),
    ]
)


def _by_lang(langs: list[str], texts: list[str]) -> Iterator[tuple[str, list[str]]]:
    for lang in dict.fromkeys(langs):
        yield lang, [text for text, own in zip(texts, langs) if own == lang and text]


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of all documents (lang, text); every task combines first."""
    arrow = to_arrow_schema(_COUNTS)

    def drained(counters: dict[str, _Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in counters.items():
            grams, counts = counter.rows()
            columns = [pa.array([lang] * len(grams)), pa.array(grams), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        counters.clear()

    def run(batches):
        counters: dict[str, _Counter] = {}
        for batch in batches:
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            for start, texts in text_slices(batch, "text"):
                for lang, own in _by_lang(langs[start:start + len(texts)], texts):
                    if own:
                        counters.setdefault(lang, _Counter()).add(own)
                if sum(c.held() for c in counters.values()) > _HELD:
                    for counter in counters.values():
                        counter.combine()
                    if sum(c.held() for c in counters.values()) > _HELD // 2:
                        yield from drained(counters)
        yield from drained(counters)

    counted = docs.select("lang", "text").mapInArrow(run, _COUNTS)
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# --- modified Kneser-Ney -------------------------------------------------------------


def _discounts(grams: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) from the counts of counts; the usual ones where these are few."""

    def exactly(k: int) -> Column:
        return F.sum((F.col("n") == k).cast("double")).alias(f"n{k}")

    sums = grams.groupBy("lang").agg(*[exactly(k) for k in (1, 2, 3, 4)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    enough = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)

    def discount(k: int) -> Column:
        value = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        bounded = F.greatest(F.lit(0.1), F.least(value, F.lit(k * 0.95)))
        return F.when(enough, bounded).otherwise(F.lit(0.5 + 0.25 * (k - 1))).alias(f"d{k}")

    return sums.select("lang", *[discount(k) for k in (1, 2, 3)])


def _with_weights(grams: DataFrame) -> DataFrame:
    """`grams` (lang, gram, n) with context, its total, its weight and the own discount."""
    size = F.length("gram")
    rows = grams.withColumn("context", F.substr("gram", F.lit(1), size - 1))
    discounts = _discounts(grams)
    n = F.col("n")

    def how_many(condition: Column, name: str) -> Column:
        return F.sum(condition.cast("double")).alias(name)

    totals = rows.groupBy("lang", "context").agg(
        F.sum("n").alias("total"),
        how_many(n == 1, "once"),
        how_many(n == 2, "twice"),
        how_many(n > 2, "more"),
    )
    weight = (
        F.col("d1") * F.col("once") + F.col("d2") * F.col("twice") + F.col("d3") * F.col("more")
    ) / F.col("total")
    totals = totals.join(discounts, "lang").select(
        "lang", "context", "total", weight.alias("weight"), "d1", "d2", "d3"
    )
    own = F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
    return rows.join(totals, ["lang", "context"]).withColumn("discount", own)


def model_tables(counts: DataFrame) -> DataFrame:
    """(size, kind, lang, gram, value): 'p' log probabilities, 'w' log context weights.

    `size` is the order; of a weight it is the order of the n-grams that it is for.
    """
    by_size = {ORDER: counts.withColumn("times", F.col("n"))}
    for size in range(ORDER - 1, 0, -1):
        tail = F.substr("gram", F.lit(2)).alias("gram")
        by_size[size] = (
            by_size[size + 1]
            .groupBy("lang", tail)
            .agg(F.count(F.lit(1)).alias("n"), F.sum("times").alias("times"))
        )
    alphabet = by_size[1].groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    lower = None
    tables = []
    for size in range(1, ORDER + 1):
        rows = _with_weights(by_size[size])
        if lower is None:
            rows = rows.join(alphabet, "lang").withColumn("q", 1.0 / F.col("v"))
        else:
            shorter = lower.select("lang", F.col("gram").alias("tail"), F.col("p").alias("q"))
            rows = rows.withColumn("tail", F.substr("gram", F.lit(2)))
            rows = rows.join(shorter, ["lang", "tail"])
        p = (F.col("n") - F.col("discount")) / F.col("total") + F.col("weight") * F.col("q")
        lower = stage(
            rows.select("lang", "gram", "context", p.alias("p"), "weight", "times"),
            f"ngrams-{size}",
        )
        name = F.lit(size).alias("size")
        seen = lower.filter(F.col("times") > 1) if size > 1 else lower
        tables.append(
            seen.select(name, F.lit("p").alias("kind"), "lang", "gram", F.ln("p").alias("value"))
        )
        contexts = lower.groupBy("lang", "context").agg(F.first("weight").alias("weight"))
        value = F.ln(F.greatest("weight", F.lit(1e-9))).alias("value")
        tables.append(
            contexts.select(name, F.lit("w").alias("kind"), "lang", F.col("context").alias("gram"), value)
        )
    found = tables[0]
    for more in tables[1:]:
        found = found.unionByName(more)
    return found


# --- hash arrays ---------------------------------------------------------------------


def _lang_seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _keys(rolled: np.ndarray, seeds: np.ndarray | np.uint64) -> np.ndarray:
    return mixed(mixed(rolled) ^ seeds)


class HashedModel:
    """Per order: sorted hashes and values of n-grams, and of contexts."""

    def __init__(self, array_of: Callable[[int, str], tuple[np.ndarray, np.ndarray]]):
        self.arrays = {}
        for size in range(1, ORDER + 1):
            for kind in "pw":
                keys, values = array_of(size, kind)
                order = np.argsort(keys)
                self.arrays[size, kind] = keys[order], values[order]

    def _look_up(self, name: tuple[int, str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, values = self.arrays[name]
        if not len(known):
            return np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return values[at], known[at] == keys

    def log_perplexity(self, texts: list[str], langs: list[str]) -> np.ndarray:
        """Mean negative log probability of the characters of each text; 0 if empty."""
        flat, lengths = _padded(texts)
        seeds = np.repeat(np.array([_lang_seed(x) for x in langs], np.uint64), lengths)
        inner = np.ones(len(flat), bool)
        begins = starts_of(lengths)[:-1]
        for k in range(ORDER - 1):
            inner[begins + k] = False
        ends = np.flatnonzero(inner)
        found = np.zeros(len(ends), np.float32)
        open_, added = np.arange(len(ends)), np.zeros(len(ends), np.float32)
        for size in range(ORDER, 0, -1):
            rolled = _rolled(flat, size)
            at = ends[open_]
            values, known = self._look_up((size, "p"), _keys(rolled[at - size + 1], seeds[at]))
            found[open_[known]] = values[known] + added[open_[known]]
            open_ = open_[~known]
            if not len(open_):
                break
            at = ends[open_]
            context = _rolled(flat, size - 1)[at - size + 1] if size > 1 else at * np.uint64(0)
            weight, has = self._look_up((size, "w"), _keys(context.astype(np.uint64), seeds[at]))
            added[open_] += np.where(has, weight, 0)
        found[open_] = added[open_] - np.float32(np.log(0x110000))
        text = np.repeat(np.arange(len(texts)), lengths - (ORDER - 1))
        sums = np.bincount(text, weights=found, minlength=len(texts))
        return -sums / np.maximum(lengths - (ORDER - 1), 1)


def hashed_tables(tables: DataFrame) -> DataFrame:
    """(size, kind, lang, key, value): the model's tables with hashes for n-grams, staged."""
    keyed = with_batch_columns(
        tables,
        _key_column,
        [T.StructField("key", T.LongType(), True)],
        ["size", "kind", "lang", "value"],
    )
    return stage(keyed.withColumn("value", F.col("value").cast("float")), "ngrams-hashed")


def hashed_model(hashed: DataFrame) -> HashedModel:
    """Brings hashes and values, no n-grams, to the driver: one order and kind at a time."""

    def array_of(size: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
        rows = hashed.filter((F.col("size") == size) & (F.col("kind") == kind))
        table = rows.select("key", "value").toArrow()
        keys = table.column("key").to_numpy().view(np.uint64)
        return keys, table.column("value").to_numpy().astype(np.float32)

    return HashedModel(array_of)


def _key_column(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    def column(name: str) -> list:
        return batch.column(batch.schema.get_field_index(name)).to_pylist()

    grams, langs = column("gram"), column("lang")
    flat, lengths = code_points(grams)
    rolled = np.zeros(len(grams), np.uint64)
    starts = starts_of(lengths)[:-1]
    for k in range(int(lengths.max(initial=0))):
        longer = lengths > k
        rolled[longer] = rolled[longer] * _FACTOR + flat[starts[longer] + k].astype(np.uint64)
    seed_of = {lang: _lang_seed(lang) for lang in set(langs)}
    seeds = np.array([seed_of[lang] for lang in langs], np.uint64)
    return {"key": pa.array(_keys(rolled, seeds).view(np.int64))}


# --- rules ---------------------------------------------------------------------------

_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_scores(docs: DataFrame, model: HashedModel) -> DataFrame:
    """`docs` (with lang, never null, and text) with base counts and log_perplexity."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        parts: dict[str, list[np.ndarray]] = {name: [] for name in (*_BASE, "log_perplexity")}
        for start, texts in text_slices(batch, "text"):
            made = base_counts(texts)
            own = langs[start:start + len(texts)]
            made["log_perplexity"] = shared.value.log_perplexity(texts, own)
            for name, values in made.items():
                parts[name].append(values)
        return {name: pa.array(np.concatenate(p or [np.empty(0)])) for name, p in parts.items()}

    fields = [T.StructField(name, T.LongType(), True) for name in _BASE]
    fields.append(T.StructField("log_perplexity", T.DoubleType(), True))
    keep = [c for c in docs.columns if c != "text"]
    return with_batch_columns(docs, compute, fields, keep)


def score_all(docs: DataFrame, hashed: DataFrame) -> DataFrame:
    """`with_scores` of all documents, the languages in as many passes as the model needs."""
    passes = max(1, -(-hashed.count() // PASS_VALUES))
    scored = []
    for number in range(passes):
        mine = F.pmod(F.xxhash64("lang"), F.lit(passes)) == number
        model = hashed_model(hashed if passes == 1 else hashed.filter(mine))
        scored.append(with_scores(docs if passes == 1 else docs.filter(mine), model))
    return functools.reduce(DataFrame.unionByName, scored)


def bands(scored: DataFrame, width: float = WIDTH) -> DataFrame:
    """(lang, middle, reach) of the log perplexity, from all documents with enough words."""
    rows = scored.filter(F.col("n_words") >= LEAST_WORDS)
    middle = rows.groupBy("lang").agg(
        F.percentile_approx("log_perplexity", F.lit(0.5), F.lit(10_000)).alias("middle")
    )
    away = F.abs(F.col("log_perplexity") - F.col("middle"))
    spread = rows.join(middle, "lang").groupBy("lang", "middle").agg(
        F.percentile_approx(away, F.lit(0.5), F.lit(10_000)).alias("spread")
    )
    reach = F.greatest(F.col("spread") * width, F.lit(LEAST_REACH))
    return spread.select("lang", "middle", reach.alias("reach"))


def judge(docs: DataFrame, width: float = WIDTH) -> DataFrame:
    """Per document: base counts, log_perplexity, base_failed, in_band, kept."""
    rows = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("lang"), "text")
    counts = stage(count_grams(rows), "ngrams-counts")
    hashed = hashed_tables(model_tables(counts))
    scored = stage(score_all(rows, hashed), "perplexity-scored")
    judged = scored.join(bands(scored, width), "lang", "left")
    reach = F.col("reach") * F.sqrt(1 + SHORT_WORDS / F.greatest(F.col("n_words"), F.lit(1)))
    inside = F.abs(F.col("log_perplexity") - F.col("middle")) <= reach
    judged = judged.withColumns(
        {"base_failed": base_failed(), "in_band": F.coalesce(inside, F.lit(True))}
    )
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("in_band")).select(
        "doc_id", *_BASE, "log_perplexity", "base_failed", "in_band", "kept"
    )
