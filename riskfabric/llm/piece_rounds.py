"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

The distinct segments of a slice of texts lie one after the other in flat numpy arrays of
symbols. In a round every segment finds its best pair (the one whose merged piece has the
highest score); pairs of that piece merge at once, leftmost first, and the arrays are
compacted; segments without a pair leave. Merging several occurrences at once equals the
library's one-at-a-time order only if nothing that the new symbol can form outranks it; for
the other pieces (``Model.alone``) just the leftmost occurrence merges in a round.

Texts are cut where no piece can cross: before a run of word marks, and around characters
that occur in no longer piece. Long segments leave the arrays for a heap, as they would need
as many rounds as merges. Merges, ranks and byte fallback come from the model file alone.

Defined results: null and empty texts encode to the end id alone and decode to an empty text;
an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskfabric.llm.common import held_alone, map_arrow, slices, texts_of
from riskfabric.llm.word_cache import read_bytes

MARK = "▁"
#: Segments of more symbols are merged through a heap, one by one.
LONG_SEGMENT = 256
#: Segments kept a worker process; the table is emptied when it is full.
MOST_SEGMENTS = 400_000
_NONE = np.int32(1 << 30)


class Model:
    """Tables of one BPE model with byte fallback, for ``encode`` and ``decode``."""

    def __init__(self, spec: bytes):
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_proto=spec)
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        piece = {i: sp.id_to_piece(i) for i in normal}
        self.eos, self.unk = sp.eos_id(), sp.unk_id()
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.by_byte = self.bytes[0] != self.unk
        # A symbol is a piece's id or, for a character that is no piece, -1 - its code point.
        self.ids = {p: i for i, p in piece.items()}
        self.of_char = -1 - np.arange(0x110000, dtype=np.int64)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        order = sorted(normal, key=lambda i: (-sp.get_score(i), i))
        self.rank = np.full(n, _NONE, np.int32)
        self.rank[order] = np.arange(len(order), dtype=np.int32)
        pairs = []
        for i in normal:
            text = piece[i]
            for k in range(1, len(text)):
                left, right = self._symbol(text[:k]), self._symbol(text[k:])
                if left is not None and right is not None:
                    pairs.append((left, right, i))
        pairs = np.array(pairs, np.int64).reshape(-1, 3)
        keys = pairs[:, 0] << 32 | pairs[:, 1] & 0xFFFFFFFF
        at = np.argsort(keys)
        self.keys, self.made = keys[at], pairs[at, 2]
        self.table = dict(zip(self.keys.tolist(), self.made.tolist(), strict=True))
        # The best rank that a pair with this piece as a part can have.
        best = np.full(n, _NONE, np.int32)
        for part in (0, 1):
            own = pairs[pairs[:, part] >= 0]
            np.minimum.at(best, own[:, part], self.rank[own[:, 2]])
        self.alone = best < self.rank
        inside = {c for p in piece.values() if len(p) > 1 for c in p}
        if any(MARK in p.lstrip(MARK) for p in piece.values()):
            raise ValueError("a piece crosses a word mark: segments can't be cut before marks")
        joined = "".join(sorted(inside - {MARK}))
        other = f"[^{re.escape(joined)}{MARK}]"
        self.segments = re.compile(f"{MARK}*[{re.escape(joined)}]+|{MARK}+|{other}")
        self.known: dict[str, bytes] = {}

    def _symbol(self, text: str) -> int | None:
        """A part of a piece as a symbol; None if merging can't have made it."""
        return self.ids.get(text, -1 - ord(text) if len(text) == 1 else None)

    def symbols(self, text: str) -> np.ndarray:
        """The characters of a text as symbols."""
        return self.of_char[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]

    def final(self, symbols: list[int]) -> list[int]:
        """Ids of what is left: characters outside the vocabulary become their bytes."""
        out = []
        for s in symbols:
            if s >= 0:
                out.append(s)
            elif self.by_byte:
                out.extend(self.bytes[b] for b in chr(-1 - s).encode("utf-8", "surrogatepass"))
            else:
                out.append(self.unk)
        return out

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.made[at], -1)

    def merge_rounds(self, flat: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their segments (ascending numbers) after the last merge, in the same order."""
        ended, owners = [], []
        flat, made = flat.copy(), self._pairs(flat, owner)
        while len(flat):
            ranks = np.where(made >= 0, self.rank[np.maximum(made, 0)], _NONE)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[first, len(flat)])
            best = np.repeat(np.minimum.reduceat(ranks, first), sizes)
            going = best != _NONE
            if not going.all():
                ended.append(flat[~going])
                owners.append(owner[~going])
                flat, owner, made, ranks, best = flat[going], owner[going], made[going], ranks[going], best[going]
                if not len(flat):
                    break
            hit = np.flatnonzero(ranks == best)
            # Leftmost first: of a run of overlapping pairs, every other one.
            run = np.flatnonzero(np.r_[True, np.diff(hit) != 1])
            place = np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))
            own = owner[hit]
            lead = np.r_[True, own[1:] != own[:-1]]
            hit = hit[(place % 2 == 0) & (lead | ~self.alone[made[hit]])]
            flat[hit] = made[hit]
            keep = np.ones(len(flat), bool)
            keep[hit + 1] = False
            # Only pairs that hold a new symbol change.
            new = np.zeros(len(flat), bool)
            new[hit] = True
            flat, owner, made, new = flat[keep], owner[keep], made[keep], new[keep]
            new[:-1] |= new[1:]
            at = np.flatnonzero(new)
            after = np.minimum(at + 1, len(flat) - 1)
            joined = (after > at) & (owner[after] == owner[at])
            made[at] = np.where(joined, self._look(flat[at], flat[after]), -1)
        if not ended:
            return flat, owner
        flat, owner = np.concatenate(ended), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return flat[order], owner[order]

    def _pairs(self, flat: np.ndarray, owner: np.ndarray) -> np.ndarray:
        made = np.full(len(flat), -1, np.int64)
        if len(flat) > 1:
            made[:-1] = np.where(owner[1:] == owner[:-1], self._look(flat[:-1], flat[1:]), -1)
        return made

    def merge_heap(self, symbols: list[int]) -> list[int]:
        """One long segment, by a heap of (rank, position) over a linked list."""
        sym, n = list(symbols), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                piece = self.table.get(sym[i] << 32 | sym[after[i]] & 0xFFFFFFFF)
                if piece is not None:
                    heapq.heappush(heap, (int(self.rank[piece]), i, sym[i], sym[after[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i] if sym[i] == left else n
            if j >= n or sym[j] != right:
                continue
            sym[i], sym[j] = self.table[left << 32 | right & 0xFFFFFFFF], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [s for s in sym if s is not None]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, the end id last."""
        end = np.array([self.eos], np.int32).tobytes()
        cut = [self.segments.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > MOST_SEGMENTS:
            self.known.clear()
        known = self.known
        new = list(set().union(*cut).difference(known)) if cut else []
        short = [w for w in new if len(w) <= LONG_SEGMENT]
        sizes = np.array([len(w) for w in short], np.int64)
        flat, owner = self.merge_rounds(self.symbols("".join(short)), np.repeat(np.arange(len(short)), sizes))
        stops = np.searchsorted(owner, np.arange(1, len(short) + 1)).tolist()
        data, at = flat.astype(np.int32).tobytes(), 0
        for w, stop in zip(short, stops, strict=True):
            known[w] = data[at * 4 : stop * 4]
            at = stop
        for k in np.unique(owner[flat < 0]).tolist():
            known[short[k]] = np.array(self.final(np.frombuffer(known[short[k]], np.int32).tolist()), np.int32).tobytes()
        for w in new:
            if len(w) > LONG_SEGMENT:
                known[w] = np.array(self.final(self.merge_heap(self.symbols(w).tolist())), np.int32).tobytes()
        get = known.__getitem__
        out = [np.frombuffer(b"".join(map(get, c)) + end, np.int32) for c in cut]
        for s in new:
            if len(s) > 64:
                del known[s]
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        """The library's texts of the ids."""
        return [self.library.decode(x) for x in ids]


def model(path: str) -> Model:
    """This worker process's model."""
    return held_alone(f"pieces of {path}", None, lambda: Model(read_bytes(path)))


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>, end id last), decoded (the text that ``ids`` decode to)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in slices(batches, most=1 << 21):
            found = m.encode(batch.column("text").to_pylist())
            ends = np.r_[0, np.cumsum([len(x) for x in found])].astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            decoded = pa.array(m.decode([x.tolist() for x in found]), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, decoded], names=["doc_id", "ids", "decoded"])

    return map_arrow(texts_of(docs, id_col, text_col), run, "doc_id long, ids array<int>, decoded string")
