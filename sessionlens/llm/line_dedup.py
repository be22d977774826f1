"""Line dedup by content-defined chunks of lines, in SQL functions only.

A line ends with a newline, and inside a paragraph (which is one long line) also behind
a full stop or comma and a space; separators belong to the line before them, so that the
lines of a text joined are the text. A rolling hash combines the hashes of each line and
the one before it; a chunk ends where the rolling hash is smaller than at both
neighbours. Boundaries thus depend on a few lines around them only and are found again
when lines are inserted before them; between two boundaries lie two lines at least.
Equal lines that follow each other have equal values and no such boundary; a chunk of more than
`MOST_LINES` lines is therefore cut again behind each `MOST_LINES` lines, so that runs of
different length, too, share their pieces.

A chunk of `LEAST_LINES` lines and `LEAST_CHARS` characters or more that occurs several
times, in one or in different documents, stays where it comes first in the order of
(doc_id, position) and is removed elsewhere. Each document counts its own repeats; the
others are counted by their bytes, once for each document. A hash only leads copies to the
bytes of the first one, with which they are compared.

Whole texts are shuffled once, by document. Chunks are combined per task before they are
shuffled; copies meet the first occurrence in a join whose other
side has one row per hash, so that a frequent chunk can be split over tasks.

Defined cases: a null or empty text has no chunks and stays as it is; rows that share a
doc_id are one document, whose first occurrences stay in all of them; a null doc_id is
one as well, and comes last; of a run of equal lines one piece stays, and what is left of the run
behind its last whole piece is a chunk like any other; an empty table stays empty;
columns named n_chunks or n_removed give way, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.texts import set_aside

LEAST_LINES, LEAST_CHARS = 2, 40
MOST_LINES = 16
SEPARATORS = (". ", ", ", "\n")
MARK = "\x01"
HASH_RANGE = 2**32
FACTOR = 31
_DIGITS = 9
#: Columns that `deduplicate` adds for a while.
_OWN = (
    "_id", "_removed", "_all", "_lines", "_hashes", "_rolled", "_ends", "_cuts", "_chunks",
    "_entries", "_kept",
)
#: Stands before chunks that may not repeat, in place of a number.
_COMMON = "-" * _DIGITS


def lines(text: Column) -> Column:
    """The lines of a text with their separators; joined they are the text."""
    marked = text
    for separator in SEPARATORS:
        marked = F.replace(marked, F.lit(separator), F.lit(separator + MARK))
    behind = "|".join(f"(?<={s})" for s in (r"\. ", ", ", r"\n"))
    found = F.when(F.contains(text, F.lit(MARK)), F.split(text, behind)).otherwise(
        F.split(marked, MARK)
    )
    return F.array_remove(found, "")


def _hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _rolled(hashes: Column) -> Column:
    def roll(value: Column, i: Column) -> Column:
        before = F.coalesce(F.get(hashes, i - 1), F.lit(0).cast("long"))
        return (before * FACTOR + value) % HASH_RANGE

    return F.transform(hashes, roll)


def _ends(rolled: Column) -> Column:
    """Number of the last line of each chunk, counted from one."""

    def is_end(i: Column) -> Column:
        value = F.get(rolled, i - 1)
        inner = (value < F.get(rolled, i - 2)) & (value < F.get(rolled, i))
        return (i == F.size(rolled)) | F.coalesce(inner, F.lit(False))

    numbers = F.when(F.size(rolled) > 0, F.sequence(F.lit(1), F.size(rolled)))
    return F.coalesce(F.filter(numbers, is_end), F.array().cast("array<int>"))


def _cuts(ends: str) -> Column:
    """The ends, and between them one behind each `MOST_LINES` lines of a longer chunk."""

    def cut(end: Column, k: Column) -> Column:
        first = F.coalesce(F.get(ends, k - 1), F.lit(0)) + MOST_LINES
        pieces = F.sequence(first, end - 1, F.lit(MOST_LINES))
        return F.when(first < end, F.array_append(pieces, end)).otherwise(F.array(end))

    return F.flatten(F.transform(ends, cut))


def _chunked(docs: DataFrame) -> DataFrame:
    """`docs` with `_chunks`: an array of (text, lines)."""
    with_lines = docs.withColumn("_lines", F.coalesce(lines(F.col("text")), F.array()))
    with_hashes = with_lines.withColumn("_hashes", F.transform("_lines", _hash))
    with_rolled = with_hashes.withColumn("_rolled", _rolled(F.col("_hashes"))).drop("_hashes")
    with_ends = with_rolled.withColumn("_ends", _ends(F.col("_rolled"))).drop("_rolled")

    with_cuts = with_ends.withColumn("_cuts", _cuts("_ends")).drop("_ends")

    def chunk(end: Column, k: Column) -> Column:
        before = F.coalesce(F.get("_cuts", k - 1), F.lit(0))
        text = F.array_join(F.slice("_lines", before + 1, end - before), "")
        return F.struct(text.alias("text"), (end - before).alias("lines"))

    return with_cuts.withColumn("_chunks", F.transform("_cuts", chunk)).drop("_cuts", "_lines")


def _long_enough(chunk: Column, least_lines: int, least_chars: int) -> Column:
    return (chunk["lines"] >= least_lines) & (F.length(chunk["text"]) >= least_chars)


def _entry(place: Column, chunk: Column, repeats: Column) -> Column:
    """A chunk as a string; those that may not repeat are equal where their texts are."""
    name = F.lpad(place.cast("string"), _DIGITS, "0")
    return F.concat(F.when(repeats, F.lit(_COMMON)).otherwise(name), chunk["text"])


def deduplicate(
    docs: DataFrame, least_lines: int = LEAST_LINES, least_chars: int = LEAST_CHARS
) -> DataFrame:
    """`docs` with repeated chunks taken out of `text`, and n_chunks, n_removed."""

    def long_enough(chunk: Column) -> Column:
        return _long_enough(chunk, least_lines, least_chars)

    distinct = _chunked(docs.select("doc_id", "text")).select(
        "doc_id",
        F.array_distinct(
            F.transform(F.filter("_chunks", long_enough), lambda c: c["text"])
        ).alias("found"),
    )
    # An inner explode would add a filter that computes the chunks once more.
    exploded = distinct.select("doc_id", F.explode_outer("found").alias("chunk"))
    chunks = exploded.filter(F.col("chunk").isNotNull())
    firsts = (
        chunks.groupBy("chunk")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
        .filter(F.col("n") > 1)
        .select(
            F.xxhash64("chunk").alias("hash"), "first_id", F.col("chunk").alias("first_chunk")
        )
    )
    # The hash spares the join the texts of one side; chunks that only share the hash
    # differ in the bytes and stay.
    hashed = chunks.select("doc_id", F.xxhash64("chunk").alias("hash"))
    copies = hashed.join(firsts, "hash")
    copies = copies.filter(~F.col("doc_id").eqNullSafe(F.col("first_id")))
    removed = copies.groupBy(F.col("doc_id").alias("_id")).agg(
        F.collect_set(F.concat(F.lit(_COMMON), "first_chunk")).alias("_removed")
    )
    docs, back = set_aside(docs, _OWN)
    joined = docs.join(removed, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    entries = _chunked(joined.withColumn("_all", F.col("text"))).withColumn(
        "_entries", F.transform("_chunks", lambda c, i: _entry(i, c, long_enough(c)))
    )
    # The difference of arrays also leaves out repeats within the document.
    kept = entries.withColumn(
        "_kept",
        F.array_except("_entries", F.coalesce("_removed", F.array().cast("array<string>"))),
    )
    rebuilt = F.array_join(F.transform("_kept", lambda e: F.substr(e, F.lit(_DIGITS + 1))), "")
    n_removed = F.size("_entries") - F.size("_kept")
    made = {
        "text": F.when(n_removed > 0, rebuilt).otherwise(F.col("_all")),
        "n_chunks": F.size("_entries"),
        "n_removed": n_removed,
    }
    names = [c for c in docs.columns if c not in ("n_chunks", "n_removed")]
    return kept.select(
        *[made["text"].alias("text") if c == "text" else F.col(c) for c in names],
        made["n_chunks"].alias("n_chunks"),
        made["n_removed"].alias("n_removed"),
    ).withColumnsRenamed(back)
