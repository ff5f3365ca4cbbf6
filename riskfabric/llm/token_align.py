"""Alignment of two tokenizers' tokens by their byte ranges.

A slice of texts is encoded by both tokenizers. Every token becomes a byte range (its vocabulary
entry's bytes laid end to end; the ranges of a text count only if the joined bytes are the
text's). ``pandas.merge_asof``, keyed by document, finds for each token's start the covering token of
the other side; the union of both directions is all overlaps, and overlaps whose ends are
equal close a group and are its link.

*Counts over the corpus.* A slice is a block: its links are numbered by distinct pairs of ids,
and the block sends each distinct pair once, with its number of links. Pairs are summed over all
blocks, compared with their B id's highest, and go back to the blocks that hold them, so that
neither a frequent pair nor a long text is one task's work: a pair has one row a block at most.

Defined results: texts null, empty, or whose joined bytes differ from the text on either side (a
U+2581 in it, for one) have no tokens: zeros and an empty string; repeated rows are documents of their
own, and each counts; very long texts are a block of their own; other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfabric.llm.common import held_alone, map_arrow, scratch_table, ship_package, slices, texts_of
from riskfabric.llm.word_cache import WordCache, read_bytes, word_cache

#: Bytes of text a block: the tokens' tables take some fifty times that.
BLOCK = 1 << 19
MARK = "▁"
#: A block's number is its partition's number times this, plus a counter.
PER_PARTITION = 1 << 32

_DOC = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_overlaps", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.list_(pa.int32()))]
_PAIR = [("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))]
_FIELDS = [("block", pa.int64()), *_DOC, *_PAIR]
_SPARK = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.int32()): "array<int>", pa.list_(pa.int64()): "array<long>"}
_SCHEMA = ", ".join(f"{n} {_SPARK[t]}" for n, t in _FIELDS)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, n_overlaps long, groups_sha256 string"


class Vocabulary:
    """Bytes of every token, one after the other, and the ids as text with what may follow them."""

    def __init__(self, tokens: list[bytes], marks: str):
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.text = [np.array([f"{i}{m}" for i in range(len(tokens))], object) for m in marks]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.size[ids]
        return self.flat[np.repeat(self.first[ids] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_level(cache: WordCache) -> Vocabulary:
    letters = byte_letters()
    names = [cache.tokenizer.id_to_token(i) or "" for i in range(cache.tokenizer.get_vocab_size())]
    return Vocabulary([bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in names], ",|")


def pieces(sp) -> Vocabulary:
    names = [bytes([int(t[3:5], 16)]) if sp.is_byte(i) else t.replace(MARK, " ").encode() for i, t in ((i, sp.id_to_piece(i)) for i in range(sp.get_piece_size()))]
    return Vocabulary(names, ",;")


class Aligner:
    """Both tokenizers and their tables."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.a, self.b = word_cache(path_a, False, (), "<u4"), SentencePieceProcessor(model_proto=read_bytes(path_b))
        self.a.tokenizer.encode_special_tokens = True  # special strings in a text are plain text
        self.bytes_a, self.bytes_b = byte_level(self.a), pieces(self.b)

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides for every text; none where the joined bytes differ from space + text."""
        spaced = [" " + t if t else "" for t in texts]
        a = [np.frombuffer(x, "<u4").astype(np.int64) for x in self.a.encode(spaced)]
        b = [np.array(x, np.int64) for x in self.b.encode(texts, num_threads=1)]
        raw = [t.encode() for t in spaced]
        for ids, table in ((a, self.bytes_a), (b, self.bytes_b)):
            sizes = [int(table.size[x].sum()) for x in ids]
            fits = [n == len(r) for n, r in zip(sizes, raw, strict=True)]
            kept = [x for x, f in zip(ids, fits, strict=True) if f]
            got = table.joined(np.concatenate(kept) if kept else np.zeros(0, np.int64))
            want = np.frombuffer(b"".join(r for r, f in zip(raw, fits, strict=True) if f), np.uint8)
            wrong = np.flatnonzero(got != want)
            ends = np.cumsum([n for n, f in zip(sizes, fits, strict=True) if f])
            bad = set(np.searchsorted(ends, wrong, side="right").tolist())
            place = iter(range(len(kept)))
            fine = [f and next(place) not in bad for f in fits]
            for k, f in enumerate(fine):
                if not f:
                    a[k], b[k], raw[k] = np.zeros(0, np.int64), np.zeros(0, np.int64), b""
        return a, b

    def align(self, texts: list[str]) -> Aligned:
        return Aligned(*self.tokens(texts), self)


def _ranges(ids: list[np.ndarray], size: np.ndarray) -> tuple[np.ndarray, pd.DataFrame, np.ndarray]:
    """All ids in a row, their starts with their documents, and their ends; bytes count over the whole slice."""
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    ends = np.cumsum(size[flat])
    doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    return flat, pd.DataFrame({"start": ends - size[flat], "doc": doc, "token": np.arange(len(flat))}), ends


class Aligned:
    """The alignment of one slice of texts.

    ``overlap_a`` and ``overlap_b`` hold the tokens' places of every overlapping pair, ``link_a``
    and ``link_b`` those of the pairs that end together, in the order of the text.
    """

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], aligner: Aligner):
        self.n, self.aligner = len(a), aligner
        self.sizes_a, self.sizes_b = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
        self.a, at_a, self.end_a = _ranges(a, aligner.bytes_a.size)
        self.b, at_b, self.end_b = _ranges(b, aligner.bytes_b.size)
        # The token of the other side that covers each token's start: the last to start at or before it.
        over_a = pd.merge_asof(at_a, at_b, on="start", by="doc", suffixes=("", "_other"))["token_other"].to_numpy()
        over_b = pd.merge_asof(at_b, at_a, on="start", by="doc", suffixes=("", "_other"))["token_other"].to_numpy()
        # Both directions find the pairs that start together.
        start_a, start_b = at_a["start"].to_numpy(), at_b["start"].to_numpy()
        later = start_a[over_b] != start_b
        self.overlap_a = np.concatenate([at_a["token"].to_numpy(), over_b[later]])
        self.overlap_b = np.concatenate([over_a, at_b["token"].to_numpy()[later]])
        self.doc_of_overlap = at_a["doc"].to_numpy()[self.overlap_a]
        same_end = self.end_a[self.overlap_a] == self.end_b[self.overlap_b]
        order = np.argsort(self.overlap_a[same_end], kind="stable")
        self.link_a, self.link_b = self.overlap_a[same_end][order], self.overlap_b[same_end][order]
        self.doc_of_link = at_a["doc"].to_numpy()[self.link_a]

    def per_doc(self, docs: np.ndarray) -> np.ndarray:
        return np.bincount(docs, minlength=self.n)

    def groups(self) -> list[str]:
        """Each document's groups: A ids, a bar, B ids; groups apart by semicolons."""
        last_a, last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        last_a[self.link_a], last_b[self.link_b] = True, True
        # A link ends its group on both sides, so a token's group is the number of links before it.
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        place_a = np.arange(len(self.a)) + np.r_[0, self.link_b + 1][group_a]
        place_b = np.arange(len(self.b)) + np.r_[self.link_a + 1, 0][group_b]
        words = np.empty(len(self.a) + len(self.b), object)
        for place, ids, last, table in ((place_a, self.a, last_a, self.aligner.bytes_a), (place_b, self.b, last_b, self.aligner.bytes_b)):
            words[place[~last]] = table.text[0][ids[~last]]
            words[place[last]] = table.text[1][ids[last]]
        words, ends = words.tolist(), np.cumsum(self.sizes_a + self.sizes_b).tolist()
        return ["".join(words[s:e])[:-1] for s, e in zip([0, *ends], ends, strict=False)]


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker process's aligner."""
    return held_alone(f"aligner of {path_a} and {path_b}", None, lambda: Aligner(path_a, path_b))


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(values, kind))


def _rows(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(n, t)) for name, t in _FIELDS], names=[name for name, _ in _FIELDS])


def blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of documents (``links``: numbers of their links' pairs in the block) and one row a block with its distinct ``pairs`` and their ``counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, block = aligner(path_a, path_b), TaskContext.get().partitionId() * PER_PARTITION
        for batch in slices(batches, most=BLOCK):
            found = both.align(batch.column("text").to_pylist())
            codes = found.a[found.link_a] << 32 | found.b[found.link_b]
            pairs, number, counts = np.unique(codes, return_inverse=True, return_counts=True)
            n, n_links = batch.num_rows, found.per_doc(found.doc_of_link)
            hashes = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups()]
            links = pa.array(n_links, pa.int64())
            yield _rows(
                {
                    "block": pa.array(np.full(n, block)), "doc_id": batch.column("doc_id"), "n_a": pa.array(found.sizes_a), "n_b": pa.array(found.sizes_b), "n_groups": links, "n_links": links,
                    "n_overlaps": pa.array(found.per_doc(found.doc_of_overlap), pa.int64()), "groups_sha256": pa.array(hashes), "links": _lists(number, n_links, pa.int32()),
                },
                n,
            )
            yield _rows({"block": pa.array([block]), "pairs": _lists(pairs, np.array([len(pairs)]), pa.int64()), "counts": _lists(counts, np.array([len(pairs)]), pa.int32())}, 1)
            block += 1

    return map_arrow(texts_of(docs, id_col, text_col), run, _SCHEMA)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair`` (A id << 32 | B id), ``total`` (its links over the corpus), ``best`` (whether no pair of its B id has more)."""
    each = rows.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    totals = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("total"))
    totals = scratch_table(totals, "align_totals")
    id_b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = totals.groupBy(id_b.alias("_b")).agg(F.max("total").alias("_most"))
    # A row a B id: at most the vocabulary's size.
    return totals.join(F.broadcast(highest), id_b == F.col("_b")).select("pair", "total", (F.col("total") == F.col("_most")).alias("best"))


def _finish(docs: pa.Table, scored: pa.Table) -> pa.Table:
    """Sum the scores of a block's pairs over the links of each document."""
    total, best = np.zeros(len(scored), np.int64), np.zeros(len(scored), np.int64)
    at = scored["at"].to_numpy()
    total[at], best[at] = scored["total"].to_numpy(), scored["best"].to_numpy(zero_copy_only=False)
    links = docs["links"].combine_chunks()
    flat = links.flatten().to_numpy()
    ends = np.cumsum(docs["n_links"].to_numpy())
    sums = [np.diff(np.r_[0, np.r_[0, np.cumsum(x[flat])][ends]]) for x in (best, total)]
    out = {name: docs[name].combine_chunks() for name in docs.column_names} | {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}
    return pa.table([out[x.split()[0]] for x in RESULT.split(", ")], names=[x.split()[0] for x in RESULT.split(", ")])


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document (columns of ``RESULT``)."""
    rows = scratch_table(blocks(docs, path_a, path_b, id_col, text_col), "align_blocks")
    asked = rows.where("pairs IS NOT NULL").select(F.col("block").alias("asker"), F.posexplode("pairs").alias("at", "pair"))
    scored = asked.join(pair_counts(rows), "pair").select("asker", "at", "total", "best")
    ship_package(docs.sparkSession)
    texts = rows.where("pairs IS NULL").drop("pairs", "counts")
    return texts.groupBy("block").cogroup(scored.groupBy("asker")).applyInArrow(_finish, RESULT)
