"""Small helpers on text columns and on batches of texts, used by several operators."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Texts are cut into numpy arrays of about this many characters, so that the memory
#: of a task depends on its longest text, not on the number of rows in a batch.
SLICE_CHARS = 2_000_000


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def set_aside(docs: DataFrame, own: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with columns that have a name of `own` renamed, and how to name them back."""
    reserved = {name.lower() for name in own}
    taken = reserved | {c.lower() for c in docs.columns}
    back = {}
    for column in docs.columns:
        if column.lower() in reserved:
            name = f"_{column}"
            while name.lower() in taken:
                name = f"_{name}"
            taken.add(name.lower())
            back[name] = column
    return docs.withColumnsRenamed({c: name for name, c in back.items()}), back


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo `modulus`; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def slices(lengths: np.ndarray, most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows with about `most` characters; a longer row is alone."""
    start, total = 0, 0
    for row, length in enumerate(lengths):
        if row > start and total + length > most:
            yield start, row
            start, total = row, 0
        total += int(length)
    if start < len(lengths):
        yield start, len(lengths)


def text_slices(
    batch: pa.RecordBatch, column: str, most: int = SLICE_CHARS
) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of a batch, slice by slice; a null text is empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    lengths = np.nan_to_num(
        np.asarray(pc.binary_length(texts).to_numpy(zero_copy_only=False), float)
    )
    for start, end in slices(lengths, most):
        yield start, [text or "" for text in texts.slice(start, end - start).to_pylist()]


def with_batch_columns(
    frame: DataFrame,
    compute: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    fields: list[T.StructField],
    keep: list[str] | None = None,
) -> DataFrame:
    """`frame` with the columns that `compute` derives from each Arrow batch.

    `keep` names the input columns to return (all by default). An input column that
    has the name of a new column, in any case of letters, is replaced.
    """
    new = [field.name for field in fields]
    taken = {name.lower() for name in new}
    kept = [c for c in (frame.columns if keep is None else keep) if c.lower() not in taken]
    schema = T.StructType([frame.schema[c] for c in kept] + fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            made = compute(batch)
            columns += [made[name] for name in new]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

    return frame.mapInArrow(run, schema)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters of `texts` as one array, and the number of characters of each."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, lengths


def starts_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))


def gather_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every range, one range after the other."""
    offsets = np.cumsum(lengths) - lengths
    return np.repeat(starts - offsets, lengths) + np.arange(int(lengths.sum()))


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit integers (splitmix finaliser)."""
    v = values.astype(np.uint64) + _MIX
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


_letters: list[np.ndarray] = []


def is_letter(points: np.ndarray) -> np.ndarray:
    """Whether each code point is a letter (Unicode categories L*)."""
    if not _letters:
        every = (unicodedata.category(chr(p))[0] == "L" for p in range(0x110000))
        _letters.append(np.fromiter(every, bool, 0x110000))
    return _letters[0][points]
