"""Token-id files: concatenated ids with Elias-Fano encoded document boundaries.

A shard is one binary file of consecutive documents in ascending identifier order:

    magic "EFTOK002", then little-endian unsigned 64-bit: documents, tokens, bytes per id, documents
    without an identifier (they come first), the smallest identifier (as two's complement), and for
    each of two sequences the low bits, bytes of the low part and bytes of the high part; then both sequences
    (samples, low part, high part each) and the ids.

The sequences are the running token counts after each document and the identifiers less the smallest one. The
low bits are packed one after the other, the high bits are a unary bit vector, about 2 + log2(largest/documents)
bits a document in all; a sample of 4 bytes holds the place of every 256th set bit. ``EliasFano.select`` finds the i-th
value from the sample before it; ``block`` does so for consecutive values, of which a reader of whole
shards holds ``READ_DOCS`` at a time. No table of 64-bit offsets or identifiers is stored or built.

One row a shard (number, documents, tokens) gives each shard's first position. Defined results: null and empty
texts hold the end id alone; documents with a null identifier come first; repeated rows are written
each, in an order of their own; very long texts are a shard of their own; an empty table writes no shard. An id beyond ``width``
bytes can't be written: the vocabulary is checked once.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskfabric.llm.common import map_arrow, slices, texts_of
from riskfabric.llm.word_cache import BYTE_SPECIALS, word_cache
from riskfabric.session import scratch_path

MAGIC = b"EFTOK002"
_HEAD = struct.Struct("<8s4Qq6Q")
SAMPLE = 256
#: Documents that a reader of whole shards reads at once.
READ_DOCS = 512
#: Tasks at most that read shards back.
READ_TASKS = 20_000
#: A shard is closed when it holds this many bytes of ids.
SHARD_BYTES = 32 << 20
_BIT = np.array([[i for i in range(8) if b >> i & 1] + [0] * (8 - bin(b).count("1")) for b in range(256)], np.uint8)
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def encode_bounds(ends: np.ndarray) -> tuple[int, bytes, bytes]:
    """(low bits, low part, high part) of a non-decreasing sequence of unsigned integers."""
    n = len(ends)
    if not n:
        return 0, b"", b""
    ends = ends.astype(np.uint64)
    low = max(0, int(ends[-1] // np.uint64(n)).bit_length() - 1)
    bits = (ends[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    high = np.zeros(n + int(ends[-1] >> np.uint64(low)) + 1, np.uint8)
    high[(ends >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
    return low, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes()


def encode_samples(highs: bytes) -> bytes:
    """The place of every ``SAMPLE``-th set bit of a high part, 4 bytes each."""
    return np.flatnonzero(np.unpackbits(np.frombuffer(highs, np.uint8), bitorder="little"))[::SAMPLE].astype("<u4").tobytes()


class EliasFano:
    """Select over the parts of ``encode_bounds`` and ``encode_samples``, as they lie in the file."""

    def __init__(self, n: int, low: int, lows: bytes, highs: bytes, samples: bytes | None = None):
        self.n, self.low = n, low
        self.lows, self.highs = np.frombuffer(lows, np.uint8), np.frombuffer(highs, np.uint8)
        self.samples = np.frombuffer(encode_samples(highs) if samples is None else samples, "<u4")

    def _low(self, i: int) -> int:
        first, last = i * self.low, (i + 1) * self.low
        part = int.from_bytes(self.lows[first // 8 : (last + 7) // 8].tobytes(), "little")
        return part >> (first % 8) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        # The set bits before the sample's byte are those before the sample less those in its byte before it.
        place = int(self.samples[i // SAMPLE])
        at = place // 8
        rank = i // SAMPLE * SAMPLE - int(_ONES[self.highs[at] & ((1 << place % 8) - 1)])
        while True:
            ones = np.cumsum(_ONES[self.highs[at : at + 64]], dtype=np.int32)
            if rank + int(ones[-1]) > i:
                break
            at, rank = at + 64, rank + int(ones[-1])
        byte = int(np.searchsorted(ones, i - rank, side="right"))
        rank += int(ones[byte - 1]) if byte else 0
        bit = (at + byte) * 8 + int(_BIT[self.highs[at + byte], i - rank])
        return (bit - i) << self.low | self._low(i)

    def block(self, a: int, b: int) -> np.ndarray:
        """Values a to b - 1: from the sample before a, only the bytes that hold them are unpacked."""
        if a >= b:
            return np.zeros(0, np.uint64)
        first = a // SAMPLE * SAMPLE
        start, after = int(self.samples[a // SAMPLE]), -(-b // SAMPLE)
        stop = int(self.samples[after]) if after < len(self.samples) else len(self.highs) * 8
        bits = np.unpackbits(self.highs[start // 8 : stop // 8 + 1], bitorder="little")
        bits[: start % 8] = 0  # bits of values before the sample
        at = np.flatnonzero(bits)[a - first : b - first] + start // 8 * 8
        high = (at - np.arange(a, b)).astype(np.uint64) << np.uint64(self.low)
        if not self.low:
            return high
        lead = a * self.low
        low = np.unpackbits(self.lows[lead // 8 : (b * self.low + 7) // 8], bitorder="little")[lead % 8 :][: (b - a) * self.low]
        return high | low.reshape(b - a, self.low).astype(np.uint64) @ (np.uint64(1) << np.arange(self.low, dtype=np.uint64))

    def span(self, i: int) -> tuple[int, int]:
        """Start and end of document i."""
        return (self.select(i - 1) if i else 0), self.select(i)


def shard_bytes(ids: list[int | None], docs: list[bytes], width: int) -> bytes:
    """One shard's file; identifiers ascend, null ones first."""
    ends = np.cumsum([len(d) // width for d in docs], dtype=np.uint64)
    known = np.array([i for i in ids if i is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    parts, sizes = [], []
    for values in (ends, known.astype(np.uint64) - np.array(least, np.int64).astype(np.uint64)):
        low, lows, highs = encode_bounds(values)
        parts += [encode_samples(highs), lows, highs]
        sizes += [low, len(lows), len(highs)]
    head = _HEAD.pack(MAGIC, len(docs), int(ends[-1]) if docs else 0, width, len(docs) - len(known), least, *sizes)
    return b"".join([head, *parts, *docs])


class Shard:
    """Random access to a shard in an open seekable file: of the ids only what is asked for is read."""

    def __init__(self, file):
        self.file = file
        magic, self.n, self.tokens, self.width, self.nulls, self.least, *sizes = _HEAD.unpack(file.read(_HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a token-id shard")
        self.first, held = _HEAD.size, []
        for n, (low, lows, highs) in ((self.n, sizes[:3]), (self.n - self.nulls, sizes[3:])):
            samples = 4 * -(-n // SAMPLE)
            held.append(EliasFano(n, low, samples=file.read(samples), lows=file.read(lows), highs=file.read(highs)))
            self.first += samples + lows + highs
        self.bounds, self.idents = held

    def ident(self, i: int) -> int | None:
        """Identifier of document i."""
        return None if i < self.nulls else self.least + self.idents.select(i - self.nulls)

    def documents(self, a: int, b: int) -> tuple[list[int | None], int, list[np.ndarray]]:
        """Identifiers of documents a to b - 1, the first one's start, and their ids, in one read."""
        start, ends = (self.bounds.select(a - 1) if a else 0), self.bounds.block(a, b).astype(np.int64)
        self.file.seek(self.first + start * self.width)
        ids = np.frombuffer(self.file.read((int(ends[-1]) - start) * self.width), f"<u{self.width}")
        known = self.idents.block(max(a - self.nulls, 0), max(b - self.nulls, 0)).tolist()
        names = [None] * (b - a - len(known)) + [self.least + i for i in known]
        return names, start, np.split(ids, ends[:-1] - start)

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds.span(i)
        self.file.seek(self.first + start * self.width)
        return np.frombuffer(self.file.read((end - start) * self.width), f"<u{self.width}")


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def write_shards(docs: DataFrame, path: str, out: str, end_id: int = 0, width: int = 2, id_col: str = "doc_id", text_col: str = "text", shard_size: int = SHARD_BYTES) -> DataFrame:
    """Write the shards under the folder ``out`` (a URI all workers share) and return the manifest:
    shard (ascending with the identifiers), file, n_docs, n_tokens.

    Each attempt of a task writes names of its own; the manifest, written once through Spark's
    committer, names the files of the attempts that count.
    """
    ordered = texts_of(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(path, False, BYTE_SPECIALS, f"<u{width}")
        if max(cache.tokenizer.get_vocab_size() - 1, end_id) >> 8 * width:
            raise ValueError(f"the vocabulary has ids that {width} bytes can't hold")
        end = np.asarray([end_id], f"<u{width}").tobytes()
        fs, folder = _fs(out)
        fs.create_dir(folder, recursive=True)
        part, made, ids, held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal made, ids, held, size
            name = f"{part:07d}-{made:05d}-{uuid.uuid4().hex}.eftok"
            with fs.open_output_stream(f"{folder}/{name}") as f:
                f.write(shard_bytes(ids, held, width))
            row = [[part * 100_000 + made], [name], [len(held)], [size // width]]
            made, ids, held, size = made + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(row[0], pa.int64()), pa.array(row[1]), pa.array(row[2], pa.int64()), pa.array(row[3], pa.int64())], names=["shard", "file", "n_docs", "n_tokens"])

        for batch in slices(batches):
            keys = batch.column("doc_id").to_pylist()
            for key, data in zip(keys, cache.encode(batch.column("text").to_pylist()), strict=True):
                ids.append(key)
                held.append(data + end)
                size += len(data) + width
                if size >= shard_size:
                    yield close()
        if held:
            yield close()

    manifest = map_arrow(ordered, run, "shard long, file string, n_docs long, n_tokens long")
    manifest.write.parquet(f"{out}/manifest")
    return docs.sparkSession.read.parquet(f"{out}/manifest")


def read_shards(manifest: DataFrame, out: str) -> DataFrame:
    """Every document read back from its shard: doc_id, start, n_tokens, ids_crc32 (over 32-bit ids)."""
    firsts = manifest.select(
        "file", "n_docs", F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _fs(out)
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist(), strict=True):
                with fs.open_input_file(f"{folder}/{name}") as f:
                    shard = Shard(f)
                    for at in range(0, shard.n, READ_DOCS):
                        keys, start, parts = shard.documents(at, min(at + READ_DOCS, shard.n))
                        sizes = np.array([len(p) for p in parts], np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(keys, pa.int64()),
                                pa.array(first + start + np.cumsum(sizes) - sizes),
                                pa.array(sizes),
                                pa.array([zlib.crc32(p.astype("<u4")) for p in parts], pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    # A task a shard: its row is a few bytes, so partitions by size would put all shards into one task.
    spread = firsts.repartitionByRange(max(1, min(manifest.count(), READ_TASKS)), "shard")
    return map_arrow(spread, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, path: str, end_id: int = 0, width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` to a new folder under the shared checkpoint folder and read it back."""
    out = scratch_path(docs.sparkSession, f"token_ids/{uuid.uuid4().hex}")
    return read_shards(write_shards(docs, path, out, end_id, width, id_col, text_col), out)
