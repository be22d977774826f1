"""Terms of texts: runs of ASCII letters, digits if wanted, and all characters beyond ASCII.

Only A to Z are lower-cased. Texts are handled as UTF-8 bytes: one table maps every byte to
itself, to its lower case, or to a space, and the terms are what the spaces leave.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sessionlens.llm.texts import slices


def _table(kept: bytes) -> bytes:
    def mapped(byte: int) -> int:
        lower = byte + 32 if 65 <= byte <= 90 else byte
        return lower if lower >= 128 or lower in kept else 32

    return bytes(map(mapped, range(256)))


_LETTERS = bytes(range(97, 123))
#: Byte tables: letters only, and letters with digits.
LETTERS = _table(_LETTERS)
LETTERS_AND_DIGITS = _table(_LETTERS + bytes(range(48, 58)))


def terms(text: bytes, table: bytes) -> list[bytes]:
    """All terms of a text in their order, repeats included."""
    return text.translate(table).split()


def byte_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8) of a batch, slice by slice; a null text is empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    lengths = np.nan_to_num(
        np.asarray(pc.binary_length(texts).to_numpy(zero_copy_only=False), float)
    )
    raw = texts.cast(pa.binary())
    for start, end in slices(lengths):
        yield start, [text or b"" for text in raw.slice(start, end - start).to_pylist()]
