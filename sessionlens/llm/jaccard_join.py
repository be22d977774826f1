"""Similarity join on word shingles with Bayesian pruning of candidates.

1. Documents with the same set of shingles form a class; one text stands for it.
2. MinHash values in `BANDS` bands of `ROWS` propose candidates: texts that share all
   values of a band lie in one bucket. A pair at the threshold 0.8 shares none of the
   bands with probability (1 - 0.8**4)**32 < 5e-8.
3. A bucket is cut into blocks of about `BLOCK` texts, and every two blocks meet in a
   group of their own, so that no task gathers a large bucket and every pair is seen.
   Buckets with the same members are examined once, and a pair only in the first band
   that it shares.
4. Within a group the MinHash values of the pairs are compared `STEP` at a time. With m
   of n values equal and a uniform prior, the similarity is at least t with probability
   P(Binomial(n + 1, t) <= m); pairs for which this falls below `TOLERANCE` are dropped.
5. What is left is verified with the whole shingle sets.
6. Groups return sums and spanning trees, never lists of pairs: per text its number of
   links and one link towards the root of its group. Components join these trees.

Defined cases: null texts and texts without words have no shingles and no links, and are
a class of their own; texts of fewer words than a shingle have one shingle; documents
with equal doc_id are documents of their own; a class id is the least doc_id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sessionlens.llm.components import components
from sessionlens.llm.staging import discard, stage
from sessionlens.llm.texts import mixed, set_aside, text_slices, with_batch_columns
from sessionlens.llm.words import shingle_sets

THRESHOLD, WIDTH = 0.8, 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP, TOLERANCE = 32, 1e-6
#: Texts of a block; a group holds two blocks at most.
BLOCK = 256
_CHUNK = 4096
_seeds = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_FACTORS, _SHIFTS = _seeds[:HASHES] | np.uint64(1), _seeds[HASHES:]


def signature(shingles: np.ndarray) -> np.ndarray:
    """`HASHES` MinHash values of a non-empty set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), _CHUNK):
        part = shingles[start:start + _CHUNK, None]
        least = np.minimum(least, (part * _FACTORS + _SHIFTS).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band's values; equal bands have equal hashes."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    rolled = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
    for k in range(ROWS):
        rolled = mixed(rolled + rows[:, :, k])
    return rolled.view(np.int64)


def set_key(shingles: np.ndarray) -> str | None:
    """A 128-bit name of a set; None for the empty set."""
    if not len(shingles):
        return None
    low, high = np.add.reduce(mixed(shingles)), np.bitwise_xor.reduce(mixed(~shingles))
    return f"{int(low):016x}{int(high):016x}"


def least_matches(compared: int, threshold: float, tolerance: float) -> int:
    """Fewest equal values of `compared` at which the posterior reaches `tolerance`."""
    n, below = compared + 1, 0.0
    for matches in range(compared + 1):
        below += math.comb(n, matches) * threshold**matches * (1 - threshold) ** (n - matches)
        if below >= tolerance:
            return matches
    return compared


def likely_pairs(
    left: np.ndarray, right: np.ndarray, threshold: float, tolerance: float
) -> np.ndarray:
    """Which rows of two arrays of signatures stay, comparing `STEP` values at a time."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for start in range(0, HASHES, STEP):
        some = slice(start, start + STEP)
        matches[alive] += (left[alive, some] == right[alive, some]).sum(axis=1)
        needed = least_matches(start + STEP, threshold, tolerance)
        alive = alive[matches[alive] >= needed]
    return alive


def jaccard_at_least(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) < threshold * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return common >= threshold * (len(a) + len(b) - common)


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text); the hash tells texts under one doc_id apart."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, key, bands): the class of each document and where to look for others."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        keys, bands = [], []
        for _, texts in text_slices(batch, "text"):
            sets = shingle_sets(texts, WIDTH)
            keys += [set_key(s) for s in sets]
            signed = [i for i, s in enumerate(sets) if len(s)]
            hashes = [None] * len(sets)
            if signed:
                found = band_hashes(np.stack([signature(sets[i]) for i in signed]))
                for i, row in zip(signed, found):
                    hashes[i] = row
            bands += hashes
        return {
            "key": pa.array(keys, pa.string()),
            "bands": pa.array(bands, pa.list_(pa.int64())),
        }

    fields = [
        T.StructField("key", T.StringType(), True),
        T.StructField("bands", T.ArrayType(T.LongType(), True), True),
    ]
    return with_batch_columns(_rows(docs), compute, fields, ["doc_id", "text_hash"])


def _buckets(classes: DataFrame) -> DataFrame:
    """(band, hash, key, copies, blocks): members of buckets of two or more."""
    rows = classes.select("key", "copies", F.posexplode("bands").alias("band", "hash"))
    counted = rows.groupBy("band", "hash").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("key")).alias("x"),
        F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"),
    )
    # Of buckets with the same members the one of the first band is enough.
    chosen = (
        counted.filter(F.col("n") > 1)
        .groupBy("n", "x", "y")
        .agg(F.min(F.struct("band", "hash")).alias("b"))
        .select(
            F.col("b.band").alias("band"),
            F.col("b.hash").alias("hash"),
            F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
        )
    )
    return rows.join(chosen, ["band", "hash"])


def _groups(buckets: DataFrame) -> DataFrame:
    """Every member once for each block that its own block meets."""
    own = F.pmod(F.xxhash64("key", F.lit(2)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = buckets.withColumn("own", own).withColumn("other", other)
    return met.select(
        "band", "hash", F.least("own", "other").alias("left"),
        F.greatest("own", "other").alias("right"), "own", "key", "copies",
    )


_LINKS = T.StructType(
    [
        T.StructField("key", T.StringType(), True),
        T.StructField("links", T.LongType(), True),
        T.StructField("root", T.StringType(), True),
    ]
)


class _Texts:
    """Shingle sets and signatures of the texts of a batch, each computed once."""

    def __init__(self):
        self.known: dict[str, tuple] = {}

    def add(self, members: list[dict]) -> None:
        new = {m["key"]: m["text"] for m in members if m["key"] not in self.known}
        for key, shingles in zip(new, shingle_sets(list(new.values()), WIDTH)):
            self.known[key] = (shingles, signature(shingles))


def _pairs_of(own: np.ndarray, left: int, right: int) -> tuple[np.ndarray, np.ndarray]:
    if left == right:
        return np.triu_indices(len(own), 1)
    i, j = np.meshgrid(np.flatnonzero(own == left), np.flatnonzero(own == right), indexing="ij")
    return i.ravel(), j.ravel()


def _linked(group: dict, texts: _Texts, threshold: float, tolerance: float) -> list[tuple]:
    """(key, links, root) of the members of a group that have a link."""
    texts.add(group["members"])
    members = {m["key"]: m for m in group["members"]}
    keys = sorted(members)
    if len(keys) < 2:
        return []
    sets = [texts.known[k][0] for k in keys]
    signatures = np.stack([texts.known[k][1] for k in keys])
    sizes = np.array([len(s) for s in sets])
    i, j = _pairs_of(np.array([members[k]["own"] for k in keys]), group["left"], group["right"])
    fits = np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j])
    i, j = i[fits], j[fits]
    alive = likely_pairs(signatures[i], signatures[j], threshold, tolerance)
    i, j = i[alive], j[alive]
    bands = band_hashes(signatures)
    first = (bands[i] == bands[j]).argmax(axis=1) == group["band"]
    copies = [members[k]["copies"] for k in keys]
    links, root = [0] * len(keys), list(range(len(keys)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(i[first].tolist(), j[first].tolist()):
        if jaccard_at_least(sets[a], sets[b], threshold):
            links[a] += copies[b]
            links[b] += copies[a]
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [(k, links[n], keys[find(n)]) for n, k in enumerate(keys) if links[n]]


def _class_texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, text): one text of each class, found by the row that stands for it."""
    wanted = classes.select(
        F.col("first.doc_id").alias("id"), F.col("first.text_hash").alias("hash"), "key"
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    return _rows(docs).join(wanted, same).select("key", "text").dropDuplicates(["key"])


def _links(groups: DataFrame, texts: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    member = F.struct("key", "copies", "own", "text")
    gathered = (
        groups.join(texts, "key")
        .groupBy("band", "hash", "left", "right")
        .agg(F.collect_list(member).alias("members"))
    )
    arrow = to_arrow_schema(_LINKS)

    def run(batches):
        for batch in batches:
            texts, rows = _Texts(), []
            for n in range(batch.num_rows):
                group = batch.slice(n, 1).to_pylist()[0]
                rows += _linked(group, texts, threshold, tolerance)
                if len(texts.known) > 20 * BLOCK:
                    texts = _Texts()
            columns = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

    return gathered.mapInArrow(run, _LINKS)


def _classified(docs: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(doc_id, text_hash, key, root, class_id, class_copies, links) of every row; `root` names
    the class of a document with words."""
    signed = stage(_signed(docs), "jaccard-signed")
    with_words = signed.filter(F.col("key").isNotNull())
    classes = with_words.groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min("doc_id").alias("doc_id"),
        F.min(F.struct("doc_id", "text_hash")).alias("first"),
    )
    one_each = with_words.dropDuplicates(["key"]).select("key", "bands")
    classes = stage(classes.join(one_each, "key"), "jaccard-classes")
    groups = stage(_groups(_buckets(classes)), "jaccard-groups")
    searched = classes.join(groups.select("key").distinct(), "key", "left_semi")
    texts = _class_texts(docs, searched)
    links = stage(_links(groups, texts, threshold, tolerance), "jaccard-links")
    discard(groups)
    roots = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    sums = links.groupBy("key").agg(F.sum("links").alias("links"))
    named = (
        classes.select("key", "copies", "doc_id")
        .join(sums, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    least = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    by_key = named.join(least, "root").select(
        "key", "root", "class_id", F.col("copies").alias("class_copies"), "links"
    )
    return signed.drop("bands").join(by_key, "key", "left")


def jaccard_classes(
    docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE
) -> DataFrame:
    """Per document: class_id, n_links, n_copies.

    `class_id` is the least doc_id of all documents that links join to it; `n_links` the
    number of other documents of similarity `threshold` or more, `n_copies` those of
    them with the same shingles.
    """
    copies = F.coalesce(F.col("class_copies") - 1, F.lit(0).cast("long"))
    alone = F.col("key").isNull()
    return _classified(docs, threshold, tolerance).select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (copies + F.coalesce("links", F.lit(0).cast("long"))).alias("n_links"),
        copies.alias("n_copies"),
    )


def one_of_each_class(docs: DataFrame) -> DataFrame:
    """The first document of each class; documents without words all stay, repeated rows once."""
    rows = _classified(docs, THRESHOLD, TOLERANCE)
    place = F.struct("doc_id", "text_hash")
    first = rows.filter(F.col("key").isNotNull()).groupBy("root").agg(F.min(place).alias("kept"))
    alone = rows.filter(F.col("key").isNull()).select(place.alias("kept"))
    kept = first.select("kept").unionByName(alone).distinct()
    docs, back = set_aside(docs, ["kept", "text_hash"])
    named = docs.withColumn("text_hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (
        F.col("text_hash") == F.col("kept.text_hash")
    )
    found = named.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return found.drop("text_hash").withColumnsRenamed(back)
