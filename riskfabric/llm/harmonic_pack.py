"""Harmonic packing of token sequences.

Class j holds pieces of at most ``capacity // j`` tokens and its bins take exactly j pieces.
A document is first cut at the capacity; what remains is put into the widest class that it
nearly fills (it leaves at most 1 / ``slack`` of the place unused), or cut at the capacity of
the next smaller class, and so on. A worker fills the bins of each class by itself, so nothing
is shuffled. The bins that are open when its rows end are closed jointly: their pieces are
laid one after the other and cut at the capacity, and the very last remainder is cut into
powers of two, which need no padding.

Defined results: a null or empty text has the end id alone; repeated rows are packed each;
an empty table gives no pieces. A task that runs again packs the same rows alike, as sequence
ids come from the partition and a counter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from riskfabric.llm.common import map_arrow, slices, texts_of
from riskfabric.llm.word_cache import LOWER_SPECIALS, word_cache

CAPACITY = 4096
#: A piece may leave 1/SLACK of its place in the bin unused.
SLACK = 64
#: sequence_id is the partition's number times this, plus a counter.
PER_PARTITION = 1 << 36

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cuts(n: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[tuple[int, int]]:
    """(class, length) of a document's pieces, in order: n = sum of lengths."""
    out = [(1, capacity)] * (n // capacity)
    rest = n % capacity
    while rest:
        j = capacity // rest  # the narrowest class whose place holds the rest
        place = capacity // j
        if (place - rest) * slack <= place:
            out.append((j, rest))
            break
        j += 1
        out.append((j, capacity // j))
        rest -= capacity // j
    return out


class Bins:
    """The open bins of one worker. Each piece is (document row, start, length)."""

    def __init__(self, first: int, capacity: int = CAPACITY):
        self.next, self.capacity = first, capacity
        self.open: dict[int, list] = {}

    def add(self, j: int, piece: tuple) -> list[tuple]:
        """Put a piece into its class; the full bin's rows (piece, sequence, offset), if it is full now."""
        held = self.open.setdefault(j, [])
        held.append(piece)
        if len(held) < j:
            return []
        del self.open[j]
        return self._close(held)

    def _close(self, held: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for piece in held:
            out.append((piece, self.next, offset))
            offset += piece[2]
        self.next += 1
        return out

    def rest(self) -> list[tuple]:
        """Close what is open: pieces in a row, cut at the capacity and then at powers of two."""
        pieces = [p for j in sorted(self.open) for p in self.open[j]]
        self.open = {}
        left = sum(p[2] for p in pieces)
        out, held, room = [], [], min(self.capacity, 1 << max(left.bit_length() - 1, 0))
        for doc, start, length in pieces:
            while length:
                take = min(length, room)
                held.append((doc, start, take))
                start, length, room, left = start + take, length - take, room - take, left - take
                if not room:
                    out += self._close(held)
                    held, room = [], min(self.capacity, 1 << max(left.bit_length() - 1, 0))
        return out


def pack(docs: DataFrame, path: str, end_id: int = 2, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """One row per piece (columns of ``PIECES``; with ``ids``, also the piece's token ids).

    At most ``capacity`` classes are open a worker, each with less than a bin of tokens, so a
    worker holds at most capacity * capacity tokens of open pieces.
    """
    schema = PIECES + (", ids array<int>" if ids else "")

    def rows(found: list[tuple]) -> pa.RecordBatch:
        cols = [[], [], [], [], [], [], [], []]
        for ((doc, data, total), start, length), sequence, offset in found:
            part = data[start * 4 : (start + length) * 4]
            for c, v in zip(cols, (doc, start, length, zlib.crc32(part), total, sequence, offset, part), strict=True):
                c.append(v)
        arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
        if ids:
            arrays.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in cols[7]], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(path, True, LOWER_SPECIALS)
        end = np.asarray([end_id], "<u4").tobytes()
        bins = Bins(TaskContext.get().partitionId() * PER_PARTITION, capacity)
        for batch in slices(batches):
            out = []
            for doc, data in zip(batch.column("doc_id").to_pylist(), cache.encode(batch.column("text").to_pylist()), strict=True):
                data += end
                whole, start = (doc, data, len(data) // 4), 0
                for j, length in cuts(len(data) // 4, capacity):
                    # An open piece keeps its own ids only, not its whole document's.
                    out += bins.add(j, (_Part(whole, start, length), start, length) if j > 1 else (whole, start, length))
                    start += length
            yield rows([((_plain(p), s, n), q, o) for (p, s, n), q, o in out])
        yield rows([((_plain(p), s, n), q, o) for (p, s, n), q, o in bins.rest()])

    return map_arrow(texts_of(docs, id_col, text_col), run, schema)


class _Part:
    """A piece's bytes, addressed as if the document before it were there."""

    __slots__ = ("doc", "first", "data", "total")

    def __init__(self, whole: tuple, start: int, length: int):
        self.doc, data, self.total = whole
        self.first, self.data = start, data[start * 4 : (start + length) * 4]

    def __getitem__(self, at: slice) -> bytes:
        return self.data[at.start - self.first * 4 : at.stop - self.first * 4]


def _plain(piece) -> tuple:
    return (piece.doc, piece, piece.total) if isinstance(piece, _Part) else piece
