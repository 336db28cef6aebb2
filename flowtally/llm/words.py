"""The words of many texts as one byte buffer, for Arrow batches in tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20       # text that is worked on at a time; a longer text is a chunk of its own
SPACE = 0x20

# White space as in ``[^\x20\x09-\x0D]+``; every other byte belongs to a word.
BY_SPACE = bytes(SPACE if b == SPACE or 0x09 <= b <= 0x0D else b for b in range(256))


@dataclass
class Words:
    """Words of a chunk in order, each followed by one space in ``buf``;
    word ``i`` lies at ``starts[i]:starts[i + 1] - 1``."""

    buf: np.ndarray             # uint8
    starts: np.ndarray          # int64, one more than words
    per_text: np.ndarray        # int64, words of each text

    def __len__(self) -> int:
        return len(self.starts) - 1

    def texts(self) -> np.ndarray:
        """The text number of every word."""
        return np.repeat(np.arange(len(self.per_text)), self.per_text)

    def bounds(self) -> np.ndarray:
        """The first word of each text, and the number of words."""
        return np.concatenate([[0], np.cumsum(self.per_text)])

    def encoded(self) -> tuple[np.ndarray, pa.Array]:
        """A number for every word, equal for equal words, and the distinct
        words (with their trailing space) by number."""
        array = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self), [None, pa.py_buffer(self.starts), pa.py_buffer(self.buf)])
        coded = array.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def text_chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``CHUNK_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // CHUNK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def split_words(texts: pa.Array, table: bytes = BY_SPACE) -> Words:
    """The words of ``texts`` (null: none): ``table`` maps every byte that
    parts words to a space and may change others."""
    column = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    raw = raw.to_pybytes()[offsets[0]:offsets[-1]] if raw is not None and len(offsets) else b""
    data = np.frombuffer(raw.translate(table), dtype=np.uint8)
    edges = offsets - offsets[0] if len(offsets) else np.zeros(1, dtype=np.int64)
    inside = data != SPACE
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    first = edges[:-1][edges[:-1] < len(data)]
    before[first] = False                       # a text's first word starts at its first byte
    begin = np.flatnonzero(inside & ~before)
    kept = np.cumsum(inside, dtype=np.int64)
    kept_before = kept[begin] - 1 if len(begin) else np.zeros(0, dtype=np.int64)
    total = int(kept[-1]) if len(kept) else 0
    lengths = np.diff(np.concatenate([kept_before, [total]]))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)]).astype(np.int64)
    buf = np.full(total + len(begin), SPACE, dtype=np.uint8)
    buf[np.arange(total) + np.repeat(np.arange(len(begin)), lengths)] = data[inside]
    per_text = np.diff(np.searchsorted(begin, edges, side="left")).astype(np.int64)
    return Words(buf, starts, per_text)
