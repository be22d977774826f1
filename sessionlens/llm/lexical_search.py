"""Ranked lexical search by dense blocked multiplication.

A set of items (the queries) is ranked against all documents. The terms of the items make a
compact vocabulary; a document is its impacts on that vocabulary. Items are taken in tiles of
bounded size. Each tile costs one pass over the texts, which keeps per document the codes and
counts of the vocabulary's terms, and one pass over these, which multiplies tiles of documents
with tiles of the vocabulary in float64. All factors are whole numbers, and a tile of the
vocabulary is so narrow that a sum of its products stays below 2**53: every product of tiles is
exact, and the tiles are added as 64-bit integers.

A task keeps for each item the best `k` documents by (score, id). A tile's k-th score cuts
off what cannot enter; what equals it stays until ids decide, so ties are safe. The best of
all tasks meet in two steps, so that no task reads more than a share of them.

Weight of a term: floor(1000 ln((2N + 2) / (2 df + 1))), N the documents with a term, df those
with this one. Impact of a term that occurs tf times in a document of n terms:
(10**9 tf) div (1000 tf + 20 m), where m = 50 + (50 n N) div L and L counts all terms.

Defined cases: a null text has no terms; a document without terms is not counted; an item
without terms, or whose terms occur nowhere, has no rows; rows of one item id are one item with the
terms of all of them; every document row is ranked, so repeated rows take a rank each; equal
scores come by ascending document id, null ids last; other columns are ignored; an empty table
gives an empty result. Texts are read whole; the longest one bounds the memory of a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sessionlens.llm.staging import discard, new_folder, stage
from sessionlens.llm.terms import LETTERS_AND_DIGITS, byte_slices, terms
from sessionlens.llm.texts import starts_of

TOP = 50
#: (item, term) pairs of a tile of items, about; they are broadcast.
TILE_PAIRS = 50_000
#: Documents and terms of a tile of the multiplication.
DOC_TILE, TERM_TILE = 1024, 512
#: Impacts are below this; sums of products must stay below the second number.
IMPACT_LIMIT, EXACT = 10**6, 2**53
#: Tasks whose best documents meet in the first step.
MERGED_TASKS = 64

_VECTORS = "doc_id long, n long, codes array<int>, counts array<int>"


class ItemTile(NamedTuple):
    """Items and their terms: pairs (number of the item, place of the term) by place.

    `place` has the place of each term of the vectors, by falling document frequency.
    """

    ids: list
    item: np.ndarray
    code: np.ndarray
    weight: np.ndarray
    place: np.ndarray
    documents: int
    occurrences: int


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term): the distinct terms of each item, as UTF-8 bytes."""
    id_type = items.schema[item].dataType
    schema = T.StructType([T.StructField("item", id_type), T.StructField("term", T.BinaryType())])
    arrow = pa.schema([("item", to_arrow_type(id_type)), ("term", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, texts in byte_slices(batch, "text"):
                found = [sorted(set(terms(value, LETTERS_AND_DIGITS))) for value in texts]
                places = [first + i for i, some in enumerate(found) for _ in some]
                flat = [term for some in found for term in some]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(places, pa.int64())).cast(arrow.field(0).type),
                     pa.array(flat, pa.binary())],
                    schema=arrow,
                )

    named = items.select(F.col(item).alias("item"), F.col(text).alias("text"))
    return named.mapInArrow(run, schema).distinct()


def document_vectors(docs: DataFrame, vocabulary: Iterable[bytes]) -> DataFrame:
    """(doc_id, n, codes, counts): per document its number of terms, and how often it holds
    those of the vocabulary, which is sent to all executors."""
    shared = docs.sparkSession.sparkContext.broadcast(
        {term: code for code, term in enumerate(vocabulary)}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_of = shared.value
        for batch in batches:
            ids = batch.column(0)
            for first, texts in byte_slices(batch, "text"):
                sizes, known, held = [], [], []
                for value in texts:
                    words = terms(value, LETTERS_AND_DIGITS)
                    codes = [c for c in map(code_of.get, words) if c is not None]
                    sizes.append(len(words))
                    held.append(len(codes))
                    known += codes
                row = np.repeat(np.arange(len(texts)), held)
                key = row * max(len(code_of), 1) + np.array(known, np.int64)
                key, counts = np.unique(key, return_counts=True)
                row, code = np.divmod(key, max(len(code_of), 1))
                offsets = starts_of(np.bincount(row, minlength=len(texts))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(texts)),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(offsets, code.astype(np.int32)),
                        pa.ListArray.from_arrays(offsets, counts.astype(np.int32)),
                    ],
                    names=["doc_id", "n", "codes", "counts"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _VECTORS)


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, occurrences: int) -> np.ndarray:
    """Impact of terms that occur `tf` times in documents of `n` terms."""
    factor = 50 * documents
    if len(n) and int(n.max()) * factor >= 2**63:
        length = np.array([int(x) * factor // occurrences for x in n], np.int64)
    else:
        length = n.astype(np.int64) * factor // max(occurrences, 1)
    tf = tf.astype(np.int64)
    return 10**9 * tf // (1000 * tf + 20 * (50 + length))


class Best:
    """The best k documents of each item so far, by falling score, then rising id."""

    def __init__(self, n_items: int, k: int):
        self.n_items, self.k = n_items, k
        self.item = np.empty(0, np.int64)
        self.score, self.doc = np.empty(0, np.int64), np.empty(0, np.int64)
        self.without_id = np.empty(0, bool)
        #: A lower score cannot enter any more.
        self.least = np.ones(n_items, np.int64)

    def offer(self, scores: np.ndarray, doc: np.ndarray, without_id: np.ndarray) -> None:
        """Scores of a tile of documents, one row a document and one column an item."""
        if len(scores) > self.k:
            kth = np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k]
            self.least = np.maximum(self.least, kth)
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        self.item = np.concatenate((self.item, item))
        self.score = np.concatenate((self.score, scores[row, item]))
        self.doc = np.concatenate((self.doc, doc[row]))
        self.without_id = np.concatenate((self.without_id, without_id[row]))
        order = np.lexsort((self.doc, self.without_id, -self.score, self.item))
        first = np.searchsorted(self.item[order], np.arange(self.n_items))
        place = np.arange(len(order)) - first[self.item[order]]
        order, place = order[place < self.k], place[place < self.k]
        self.item, self.score = self.item[order], self.score[order]
        self.doc, self.without_id = self.doc[order], self.without_id[order]
        last = place == self.k - 1
        self.least[self.item[last]] = self.score[last]


def tile_scores(
    row: np.ndarray, code: np.ndarray, impact: np.ndarray, n_docs: int, tile: ItemTile, width: int
) -> np.ndarray:
    """Exact scores of a tile of documents for all items of `tile`.

    The vocabulary is taken in tiles of `width` terms. Of each, only documents that hold
    one of its terms, and only items that do, are multiplied.
    """
    scores = np.zeros((n_docs, len(tile.ids)), np.int64)
    order = np.argsort(code, kind="stable")
    row, code, impact = row[order], code[order], impact[order]
    n_tiles = (int(tile.code[-1]) // width + 1) if len(tile.code) else 0
    edges = np.arange(n_tiles + 1) * width
    in_docs, in_items = np.searchsorted(code, edges), np.searchsorted(tile.code, edges)
    for number in range(n_tiles):
        here = slice(in_docs[number], in_docs[number + 1])
        if here.start == here.stop:
            continue
        there = slice(in_items[number], in_items[number + 1])
        some_docs, doc = np.unique(row[here], return_inverse=True)
        some_items, item = np.unique(tile.item[there], return_inverse=True)
        left = np.zeros((len(some_docs), width))
        left[doc, code[here] - edges[number]] = impact[here]
        right = np.zeros((width, len(some_items)))
        right[tile.code[there] - edges[number], item] = tile.weight[there]
        scores[np.ix_(some_docs, some_items)] += (left @ right).astype(np.int64)
    return scores


def tile_width(weight: np.ndarray) -> int:
    """Terms of a vocabulary tile whose products surely sum up to less than 2**53."""
    heaviest = max(int(weight.max(initial=0)), 1)
    return max(1, min(TERM_TILE, (EXACT - 1) // (heaviest * IMPACT_LIMIT)))


def best_of_tasks(vectors: DataFrame, tile: ItemTile, id_type: T.DataType, k: int) -> DataFrame:
    """(item, doc_id, score, task): the best documents of each task for each item."""
    shared = vectors.sparkSession.sparkContext.broadcast(tile)
    kind = to_arrow_type(id_type)
    schema = T.StructType(
        [
            T.StructField("item", id_type),
            T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.LongType()),
            T.StructField("task", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = shared.value
        best, width = Best(len(tile.ids), k), tile_width(tile.weight)
        for batch in batches:
            for start in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(start, DOC_TILE)
                codes = part.column(2)
                row = np.repeat(np.arange(part.num_rows), np.diff(codes.offsets.to_numpy()))
                if not len(row):
                    continue
                n = part.column(1).to_numpy()
                impact = impacts(
                    part.column(3).flatten().to_numpy(), n[row], tile.documents, tile.occurrences
                )
                code = tile.place[codes.flatten().to_numpy()]
                scores = tile_scores(row, code, impact, part.num_rows, tile, width)
                ids = part.column(0)
                best.offer(
                    scores,
                    ids.fill_null(0).to_numpy(),
                    ids.is_null().to_numpy(zero_copy_only=False),
                )
        places = pa.array(best.item, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(tile.ids, kind).take(places),
                pa.array(best.doc, pa.int64(), mask=best.without_id),
                pa.array(best.score, pa.int64()),
                pa.array(np.full(len(best.item), TaskContext.get().partitionId()), pa.int32()),
            ],
            names=schema.fieldNames(),
        )

    return vectors.mapInArrow(run, schema)


def _ranked(rows: DataFrame, k: int, *groups) -> DataFrame:
    order = Window.partitionBy("item", *groups).orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last()
    )
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _tile(
    pairs: list, vocabulary: list[bytes], df: np.ndarray, documents: int, occurrences: int
) -> ItemTile:
    """The tile of some (item, term) rows. Frequent terms share the first vocabulary tiles, so
    most documents hold none of the terms of the last ones."""
    code_of = {term: code for code, term in enumerate(vocabulary)}
    ids = list(dict.fromkeys(row["item"] for row in pairs))
    number_of = {item: number for number, item in enumerate(ids)}
    place = np.empty(len(vocabulary), np.int64)
    place[np.argsort(-df, kind="stable")] = np.arange(len(vocabulary))
    code = np.array([code_of[bytes(row["term"])] for row in pairs], np.int64)
    item = np.array([number_of[row["item"]] for row in pairs], np.int64)
    ratio = [(2 * documents + 2) / (2 * int(count) + 1) for count in df]
    weight = np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)[code]
    order = np.lexsort((item, place[code]))
    return ItemTile(
        ids, item[order], place[code][order], weight[order], place, documents, occurrences
    )


def _search_tile(docs: DataFrame, pairs: list, id_type: T.DataType, k: int, path: str) -> None:
    """Ranks a tile of items against all documents and writes the result to `path`."""
    vocabulary = sorted({bytes(row["term"]) for row in pairs})
    vectors = stage(document_vectors(docs, vocabulary), "vectors")
    totals = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    held = vectors.select(F.explode("codes").alias("code")).groupBy("code").count()
    for row in held.collect():  # one row a term of the tile
        df[row["code"]] = row["count"]
    rows = best_of_tasks(vectors, _tile(pairs, vocabulary, df, *totals), id_type, k)
    shares = rows.withColumn("share", F.expr(f"task div {MERGED_TASKS}"))
    best = _ranked(_ranked(shares, k, "share").drop("rank"), k)
    best.select("item", F.col("rank").cast("int"), "doc_id", "score").write.parquet(path)
    discard(vectors)


def search(
    docs: DataFrame, items: DataFrame, item: str = "item_id", text: str = "text", k: int = TOP
) -> DataFrame:
    """(`item`, rank, doc_id, score): the k documents with the highest scores above 0 for each
    item. `docs` has doc_id and text."""
    spark = docs.sparkSession
    id_type = items.schema[item].dataType
    pairs = stage(item_terms(items, item, text), "item-terms")
    n_tiles = -(-pairs.count() // TILE_PAIRS)
    folder, paths = new_folder(spark, "ranked"), []
    for number in range(n_tiles):
        tile = F.pmod(F.xxhash64("item"), F.lit(n_tiles)) == number
        some = pairs.filter(tile).collect()
        if some:
            paths.append(f"{folder}/{number}")
            _search_tile(docs, some, id_type, k, paths[-1])
    discard(pairs)
    schema = T.StructType([T.StructField("item", id_type)]).add("rank", T.IntegerType())
    schema = schema.add("doc_id", T.LongType()).add("score", T.LongType())
    found = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return found.withColumnRenamed("item", item)
