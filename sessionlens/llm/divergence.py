"""Source divergence audit by joint traversal of quadtrees.

Every language is a sparse matrix of groups (its sources) by kept terms, holding counts. Each
group and the language as a whole give a term the probability
p = 1 + floor(10**9 (count + 1) / (N + V)): N counts the group's occurrences of kept terms, V the
kept terms. The divergence of a group from another at a term is floor((p - q)**2 / q).

Spark counts, keeps and lays the matrix out in blocks of columns, and of rows where a language has
very many sources. The rows of one or two row blocks in one column block are k**2-trees with
k = 2: a quadrant without a count is a leaf without children, whatever its size. Pairs of trees are
walked together, quadrant by quadrant. Where both sides are empty, all terms of the quadrant
cost the same for a pair of groups, so they are only counted, and priced by one product at the end;
where one side has counts, the walk goes down to the terms. The columns that a pair of blocks
does not hold at all are one more empty quadrant. The walk is done in bounded portions.

All arithmetic is exact, on whole numbers, up to 9 * 10**15 occurrences in a language.

Defined cases: null text, lang or source count as ''; a group without terms has N = 0 and takes
part; a language without kept terms has value 0 for all pairs and no terms; equal values are
ranked by the UTF-8 bytes of the item; repeated rows count as often as they occur; other columns are
ignored; an empty table gives an empty result. Texts are read whole, and the longest one bounds
the memory of a task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.staging import discard, stage
from sessionlens.llm.terms import LETTERS, byte_slices, terms

#: A term is kept in a language if so many of its documents hold it.
LEAST_DOCUMENTS = 3
#: Ranks of the terms of a group.
TOP_TERMS = 200
#: Distinct terms that a task counts before it gives them back.
HELD = 400_000
#: Cells and terms of a column block, groups of a row block; all are means of a hash.
BLOCK_CELLS, BLOCK_TERMS, BLOCK_GROUPS = 50_000, 4096, 256
#: Languages that are broadcast; with more of them their sizes are joined by a shuffle.
BROADCAST_LANGUAGES = 10_000
#: Triples (quadrant of rows, quadrant of rows, quadrant of terms) walked at once.
PORTION = 250_000
SCALE = 10**9

_COUNTED = "lang string, source string, term string, n long, docs long"
_PRICED = (
    "lang string, source string, part string, item string, value long, terms long, empty long"
)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; a row without term tells that
    the group occurs. Tasks count as much as they can hold before anything is shuffled."""
    names = [field.split()[0] for field in _COUNTED.split(", ")]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    schema = pa.schema(list(zip(names, types)))

    def drained(found: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (occurrences, documents) in found.items():
            words = list(occurrences)
            n = [*map(occurrences.__getitem__, words), 0]
            held = [*map(documents.__getitem__, words), 0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(n)),
                    pa.array([source] * len(n)),
                    pa.array([*words, None], pa.binary()).cast(pa.string()),
                    pa.array(n, pa.int64()),
                    pa.array(held, pa.int64()),
                ],
                schema=schema,
            )
        found.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            groups = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for first, texts in byte_slices(batch, "text"):
                for group, text in zip(groups[first:], texts):
                    occurrences, documents = found.setdefault(group, (Counter(), Counter()))
                    words = terms(text, LETTERS)
                    occurrences.update(words)
                    documents.update(set(words))
                if sum(len(pair[0]) + 1 for pair in found.values()) > HELD:
                    yield from drained(found)
        yield from drained(found)

    def known(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(column)

    counted = docs.select(known("lang"), known("source"), "text").mapInArrow(run, _COUNTED)
    return counted.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def kept_cells(counts: DataFrame) -> DataFrame:
    """(lang, source, term, n, lang_n, is_first) of the kept terms; one of the rows of a
    term is the first."""
    of_term = Window.partitionBy("lang", "term")
    return (
        counts.filter(F.col("term").isNotNull())
        .withColumns(
            {
                "lang_docs": F.sum("docs").over(of_term),
                "lang_n": F.sum("n").over(of_term),
                "is_first": (F.col("source") == F.min("source").over(of_term)).cast("long"),
            }
        )
        .filter(F.col("lang_docs") >= LEAST_DOCUMENTS)
        .drop("docs", "lang_docs")
    )


def prices(counts: np.ndarray, total: np.ndarray | int, n_terms: int) -> np.ndarray:
    """1 + floor(10**9 (count + 1) / (total + n_terms)), by long division to base 1000."""
    whole = np.asarray(total, np.int64) + n_terms
    rest = np.asarray(counts, np.int64) + 1
    if np.max(whole, initial=0) > 9 * 10**15:
        raise OverflowError("more than 9 * 10**15 occurrences")
    price = rest // whole
    rest = rest % whole
    for _ in range(3):
        rest = rest * 1000
        price, rest = price * 1000 + rest // whole, rest % whole
    return price + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Quadtree:
    """A k**2-tree (k = 2) of the nonzero cells of a matrix of 2**height rows and columns.

    `child[level][node, digit]` is the node of a quadrant on the next level, -1 if it is empty;
    a digit is 2 * (lower half of the rows) + (right half of the columns). The nodes of the last
    level are the cells, `cells` has their places in the arrays that were given.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, height: int):
        code = np.zeros(len(rows), np.int64)
        for bit in range(height):
            digit = (rows >> bit & 1) << 1 | (columns >> bit & 1)
            code |= digit << (2 * bit)
        self.cells = np.argsort(code)
        nodes = code[self.cells]
        self.child = []
        for _ in range(height):
            parents, parent = np.unique(nodes >> 2, return_inverse=True)
            child = np.full((max(len(parents), 1), 4), -1, np.int64)
            child[parent, nodes & 3] = np.arange(len(nodes))
            self.child.append(child)
            nodes = parents
        self.child.reverse()
        self.root = 0 if len(rows) else -1


def _children(tree: Quadtree, level: int, nodes: np.ndarray, half: int, right: int) -> np.ndarray:
    found = tree.child[level][nodes, 2 * half + right]
    return np.where(nodes >= 0, found, -1)


def joint_walk(
    left: Quadtree, right: Quadtree, height: int, shape: tuple[int, int, int], same: bool
) -> Iterator[tuple]:
    """Walks two trees over the same columns, and yields portions of what it meets.

    `shape` has the rows of both and the columns. With `same` only pairs of rows g < h are met.
    ("empty", level, A, B, C): quadrants of rows A and B without counts in the columns C.
    ("cells", 0, g, h, nodes of g, nodes of h): pairs of rows at a column in which one has a count.
    """
    start = np.zeros(1, np.int64)
    stack = [(0, start, start, start, start + left.root, start + right.root)]
    while stack:
        level, a, b, c, node_a, node_b = stack.pop()
        empty = (node_a < 0) & (node_b < 0)
        if empty.any():
            yield "empty", height - level, a[empty], b[empty], c[empty]
            a, b, c, node_a, node_b = (x[~empty] for x in (a, b, c, node_a, node_b))
        if not len(a):
            continue
        if level == height:
            yield "cells", 0, a, b, node_a, node_b
            continue
        if len(a) > PORTION:
            middle = len(a) // 2
            for part in (slice(middle), slice(middle, None)):
                stack.append((level, *(x[part] for x in (a, b, c, node_a, node_b))))
            continue
        size = 1 << (height - level - 1)
        made = []
        for half_c in range(2):
            column = 2 * c + half_c
            for half_a in range(2):
                row_a = 2 * a + half_a
                child_a = _children(left, level, node_a, half_a, half_c)
                for half_b in range(2):
                    row_b = 2 * b + half_b
                    inside = (row_a * size < shape[0]) & (row_b * size < shape[1])
                    inside &= column * size < shape[2]
                    if same:
                        inside &= row_a < row_b if size == 1 else row_a <= row_b
                    child_b = _children(right, level, node_b, half_b, half_c)
                    made.append([x[inside] for x in (row_a, row_b, column, child_a, child_b)])
        stack.append((level + 1, *(np.concatenate(parts) for parts in zip(*made))))


class Rows:
    """The rows of one block: groups in the order of their names, their cells and prices."""

    def __init__(self, names: np.ndarray, totals: np.ndarray, n_terms: int):
        order = np.argsort(names)
        self.names, self.totals, self.n_terms = names[order], totals[order], n_terms
        if n_terms:
            self.zero = prices(np.zeros(len(names), np.int64), self.totals, n_terms)
        else:
            self.zero = np.ones(len(names), np.int64)

    def fill(self, source: np.ndarray, column: np.ndarray, counts: np.ndarray, height: int) -> None:
        self.row, self.column, self.counts = np.searchsorted(self.names, source), column, counts
        self.tree = Quadtree(self.row, column, height)
        self.price = prices(counts, self.totals[self.row], self.n_terms)
        #: Prices in the order of the tree's last level; the last one stands for "no cell".
        self.of_node = np.append(self.price[self.tree.cells], 0)


def pair_values(left: Rows, right: Rows, height: int, n_columns: int, same: bool) -> np.ndarray:
    """Two matrices: values of (row of left, row of right), and of (row of right, row of left),
    over the columns of the block. With `same` only rows g < h are right."""
    shape = (len(left.names), len(right.names))
    values = np.zeros((2, shape[0] * shape[1]), np.int64)
    corners = np.zeros((shape[0] + 1, shape[1] + 1), np.int64)
    for kind, level, a, b, *rest in joint_walk(
        left.tree, right.tree, height, (*shape, n_columns), same
    ):
        if kind == "empty":
            size = 1 << level
            width = np.minimum((rest[0] + 1) * size, n_columns) - rest[0] * size
            a0, a1 = a * size, np.minimum((a + 1) * size, shape[0])
            b0, b1 = b * size, np.minimum((b + 1) * size, shape[1])
            for row, column, sign in ((a0, b0, 1), (a1, b1, 1), (a0, b1, -1), (a1, b0, -1)):
                np.add.at(corners, (row, column), sign * width)
        else:
            node_a, node_b = rest
            p = np.where(node_a >= 0, left.of_node[node_a], left.zero[a])
            q = np.where(node_b >= 0, right.of_node[node_b], right.zero[b])
            pair = a * shape[1] + b
            np.add.at(values[0], pair, divergence(p, q))
            np.add.at(values[1], pair, divergence(q, p))
    empty = corners.cumsum(axis=0).cumsum(axis=1)[:-1, :-1]
    values = values.reshape(2, *shape)
    p, q = left.zero[:, None], right.zero[None, :]
    values[0] += empty * divergence(p, q)
    values[1] += empty * divergence(q, p)
    return values


def _best_terms(rows: Rows, names: np.ndarray, lang_n: np.ndarray, lang_total: int, top: int):
    """(row, column, value): per group the terms that it gives more weight than the language."""
    q = prices(lang_n, lang_total, rows.n_terms)
    more = np.flatnonzero(rows.price > q)
    value = divergence(rows.price[more], q[more])
    row, column = rows.row[more], rows.column[more]
    order = np.lexsort((column, -value, row))
    row, column, value = row[order], column[order], value[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    best = place < top
    return row[best], names[column[best]], value[best]


def _names(column: pa.ChunkedArray) -> np.ndarray:
    """Strings as a numpy array; they compare by code points, as their UTF-8 does by bytes."""
    return np.array(column.to_pylist(), object)


def audit_block(table: pa.Table, top: int = TOP_TERMS) -> pa.Table:
    """Priced pairs and terms of a column block and one or two row blocks of a language.

    Rows without a term are the groups, `n` is their total; the others are cells.
    """
    row_block, n_terms = table["row_block"].to_numpy(), table["n_terms"][0].as_py()
    lang_total, lang = table["lang_total"][0].as_py(), table["lang"][0].as_py()
    first, second = table["a"][0].as_py(), table["b"][0].as_py()
    is_cell = table["term"].is_valid().to_numpy()
    source, n = _names(table["source"]), table["n"].to_numpy()
    lang_n = table["lang_n"].fill_null(0).to_numpy()
    names, column = np.unique(_names(table["term"].filter(pa.array(is_cell))), return_inverse=True)
    place = np.zeros(len(n), np.int64)
    place[is_cell] = column
    blocks = {}
    for block in (first, second):
        mine = row_block == block
        blocks[block] = Rows(source[mine & ~is_cell], n[mine & ~is_cell], n_terms)
    widest = max(len(names), *(len(rows.names) for rows in blocks.values()), 1)
    height = int(widest - 1).bit_length()
    for block, rows in blocks.items():
        mine = (row_block == block) & is_cell
        rows.fill(source[mine], place[mine], n[mine], height)
    same = first == second
    left, right = blocks[first], blocks[second]
    made = []
    if len(left.names) and len(right.names):
        values = pair_values(left, right, height, len(names), same)
        g, h = np.nonzero(np.ones(values.shape[1:], bool))
        if same:
            g, h = g[g < h], h[g < h]
        for rows, others, at, of, value in (
            (left, right, g, h, values[0][g, h]),
            (right, left, h, g, values[1][g, h]),
        ):
            empty = divergence(rows.zero[at], others.zero[of])
            made.append((rows.names[at], "pair", others.names[of], value, len(names), empty))
    if same and len(names):
        mine = (row_block == first) & is_cell
        row, item, value = _best_terms(left, names, lang_n[mine], lang_total, top)
        made.append((left.names[row], "term", item, value, 0, np.zeros(len(row), np.int64)))
    parts = [
        pa.table(
            {
                "lang": pa.array([lang] * len(value), pa.string()),
                "source": pa.array(source, pa.string()),
                "part": pa.array([part] * len(value), pa.string()),
                "item": pa.array(item, pa.string()),
                "value": pa.array(value, pa.int64()),
                "terms": pa.array(np.full(len(value), n_columns), pa.int64()),
                "empty": pa.array(empty, pa.int64()),
            }
        )
        for source, part, item, value, n_columns, empty in made
    ]
    return pa.concat_tables(parts) if parts else _EMPTY


_EMPTY = pa.table(
    {
        name: pa.array([], pa.string() if kind == "string" else pa.int64())
        for name, kind in (field.split() for field in _PRICED.split(", "))
    }
)


def _sizes(groups: DataFrame) -> DataFrame:
    """Per language: V, N, and the numbers of its column blocks and row blocks."""

    def share(count: str, size: int):
        return F.ceil(F.col(count) / size)

    sums = groups.groupBy("lang").agg(
        F.sum("firsts").alias("n_terms"),
        F.sum("total").alias("lang_total"),
        F.sum("cells").alias("cells"),
        F.count("*").alias("n_groups"),
    )
    return sums.select(
        "lang",
        "n_terms",
        "lang_total",
        F.greatest(F.lit(1), share("cells", BLOCK_CELLS), share("n_terms", BLOCK_TERMS))
        .cast("int").alias("column_blocks"),
        F.greatest(F.lit(1), share("n_groups", BLOCK_GROUPS)).cast("int").alias("row_blocks"),
    )


def _in_blocks(cells: DataFrame, groups: DataFrame, languages: DataFrame) -> DataFrame:
    """Cells and groups in every pair (a, b) of row blocks and every column block they meet."""
    if languages.count() <= BROADCAST_LANGUAGES:
        languages = F.broadcast(languages)
    row_block = F.pmod(F.xxhash64("source"), F.col("row_blocks")).cast("int")
    column_block = F.pmod(F.xxhash64("term"), F.col("column_blocks")).cast("int")
    columns = F.sequence(F.lit(0), F.col("column_blocks") - 1)
    placed = cells.join(languages, "lang").withColumn("block", column_block).unionByName(
        groups.select("lang", "source", F.col("total").alias("n"))
        .join(languages, "lang")
        .withColumn("block", F.explode(columns)),
        allowMissingColumns=True,
    )
    return (
        placed.withColumn("row_block", row_block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))
        .select(
            "lang", "source", "term", "n", "lang_n", "n_terms", "lang_total", "row_block", "block",
            F.least("row_block", "other").alias("a"), F.greatest("row_block", "other").alias("b"),
        )
    )


def audit(docs: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group; `docs` has text, lang, source.

    Part "pair" ranks the other sources of the language by the divergence from them over all
    kept terms; part "term" ranks the terms that the group uses more than its language does.
    """
    counts = stage(term_counts(docs), "term-counts")
    cells = stage(kept_cells(counts), "cells")
    by_group = cells.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count("*").alias("cells"), F.sum("is_first").alias("firsts")
    )
    occurring = counts.filter(F.col("term").isNull()).select("lang", "source")
    groups = stage(occurring.join(by_group, ["lang", "source"], "left").na.fill(0), "groups")
    discard(counts)
    languages = stage(_sizes(groups), "languages")
    blocks = _in_blocks(cells.drop("is_first"), groups, languages)

    def priced_block(table: pa.Table) -> pa.Table:
        return audit_block(table, top)

    priced = stage(
        blocks.groupBy("lang", "a", "b", "block").applyInArrow(priced_block, _PRICED), "priced"
    )
    for staged in (cells, groups):
        discard(staged)
    keys = ["lang", "source", "part", "item"]
    sums = priced.filter(F.col("part") == "pair").groupBy(*keys).agg(
        F.sum("value").alias("value"), F.sum("terms").alias("terms"), F.max("empty").alias("empty")
    )
    n_terms = languages.select("lang", "n_terms")
    if languages.count() <= BROADCAST_LANGUAGES:
        n_terms = F.broadcast(n_terms)
    unmet = (F.col("n_terms") - F.col("terms")) * F.col("empty")
    pairs = sums.join(n_terms, "lang").select(*keys, (F.col("value") + unmet).alias("value"))
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(ranked)
    best = priced.filter(F.col("part") == "term").select(*keys, "value").withColumn("rank", rank)
    return pairs.withColumn("rank", rank).unionByName(best.filter(F.col("rank") <= top))
