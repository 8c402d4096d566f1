"""Text columns of Arrow batches as arrays of bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def text_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of a text column one after the other, and where each row begins and ends."""
    column = column.cast(pa.large_binary())
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, "<i8")[column.offset : column.offset + len(column) + 1]
    letters = np.frombuffer(data, "u1")[offsets[0] : offsets[-1]] if data else np.empty(0, "u1")
    return letters, offsets - offsets[0]


def one_a_character(letters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As text_of, with one byte a character, so that places in a row count characters."""
    heads = letters & 0xC0 != 0x80
    if heads.all():
        return letters, offsets
    return letters[heads], np.concatenate([[0], np.cumsum(heads)])[offsets]
