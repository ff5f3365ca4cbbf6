"""Shingle-set similarity join by parity sketches: exact, without comparing all pairs.

A document's set holds its distinct five-word shingles. Documents with the same set are one
class (a 128-bit fingerprint of the set); only classes are compared.

*Sketch.* In size band k (sizes 2^k to 2^(k+1)-1) the shingles are dealt by hash over m_k
places and each place holds the XOR of its shingles' hashes. A shingle that only one of two
sets has changes one place, so the number of places that differ (the Hamming distance of the
sketches) is at most the symmetric difference D of the sets.

*Pigeonhole.* Jaccard >= 0.8 means D <= (|A| + |B|) / 9. If two sketches of m places differ in
at most D of them, then in any order of the pairs (place, value) common to all sketches the
first common pair is among the first D + 1 of either. The order is: places with shingles by
number, then empty ones. So a class sends the first D + 1 pairs as keys, with D the most for
any partner's size; a class that may have a partner in the next band sends keys of that
band as well. Every linked pair shares a key. The first one that it shares, in that order, is
within the first D + 1 of both, D for these two sizes.

Any order that is the same for all documents will do, so keys that very many sets share (a
common passage or line) go last: the sets' pass also counts all keys in a fixed number of slots,
and the slots with high counts form a bit set of a fixed size that every worker gets.

*Candidates.* Sets are first compared with one or a few others of their keys (the smallest,
then neighbours), a round at a time, and the links found are joined into components, so that a
large group of near copies needs few comparisons. The remaining candidates are the pairs of
a key that lie in different components, of which one lies outside the component that most
sets of the key are in. A pair comes from the first key that it shares, not from all: a key
travels with its number in the set's order and the set's keys before it, and a pair is left out at
a key whose number is beyond its D, or where both sets have one of those before in common. All
pairs that come are compared, so no link between two components is missed;
the links found are those of a spanning tree and some more. ``jaccard_links`` is the full join: it
compares all pairs of a key and gives every linked pair of classes. A
one-bit parity sketch of the whole set (bits, not hashes) rejects most candidates; the others
are verified on their texts.

Defined results: null and empty texts, and texts of white space, have an empty set and no
links; fewer than five words are one shingle; repeated rows are copies of each other; a null
identifier belongs to the component of the documents with its set (null if it is alone); an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfabric.llm.common import map_arrow, scratch_table, slices, texts_of

WORDS = 5
#: Places of a band's sketch for each shingle of its largest set.
PLACES_PER_SHINGLE = 0.4
#: Slots in which keys are counted, and the count (over the mean, twofold) from which a slot's keys go last.
SLOTS, HOT = 1 << 24, 4
#: Rounds in which a set is compared with single others before all remaining candidates are.
ROUNDS = 3
#: Words of the sketch's fold that travels with the keys: it rejects most pairs of sets of up to a thousand shingles.
FOLD = 8
#: Keys of a set that travel with its next key: two sets that have one of them in common have met there.
BEFORE = 8
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes half of the output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_P = _U(0x9E3779B97F4A7C15 | 1)
_Q = _U(0xC2B2AE3D27D4EB4F | 1)


#: Bytes whose running sums are held at once.
BLOCK = 1 << 18
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2^64."""
    if n > BLOCK + 1:  # a single word as long as that
        return np.cumprod(np.r_[_U(1), np.full(n - 1, base, np.uint64)], dtype=np.uint64)
    if base not in _POWERS:
        _POWERS[base] = np.cumprod(np.r_[_U(1), np.full(BLOCK, base, np.uint64)], dtype=np.uint64)
    return _POWERS[base][:n]


def _word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each word: its bytes' values by powers of an odd base, from running sums of a block.

    Dividing by the power at the word's start makes the hash independent of the place.
    """
    out, i = np.empty(len(starts), np.uint64), 0
    inverse = pow(int(_P), -1, 1 << 64)
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(stops, base + BLOCK, side="right")))
        part = _BYTE[data[base : stops[j - 1]]]
        sums = np.r_[_U(0), np.cumsum(part * _powers(int(_P), len(part)), dtype=np.uint64)]
        a, b = starts[i:j] - base, stops[i:j] - base
        out[i:j] = _mix((sums[b] - sums[a]) * _powers(inverse, len(part) + 1)[a] + (b - a).astype(np.uint64))
        i = j
    return out


def shingle_sets(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, documents): the distinct shingles of each document, sorted by document and hash.

    ``data`` holds the texts' bytes one after the other, ``ends`` where each text ends.
    """
    n_docs = len(ends)
    space = np.r_[_SPACE[data], True]
    begin = np.r_[0, ends[:-1]]
    fresh = np.zeros(len(data) + 1, bool)  # first byte of a text
    fresh[begin[begin < len(data)]] = True
    inside = ~space[:-1]
    starts = np.flatnonzero(inside & (np.r_[True, space[:-2]] | fresh[:-1])) if len(data) else np.zeros(0, np.int64)
    stops = np.flatnonzero(inside & (space[1:] | fresh[1:])) + 1 if len(data) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = _word_hashes(data, starts, stops)
    doc = np.searchsorted(ends, starts, side="right")
    per = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(per) - per
    # A shingle: WORDS words, or all words of a shorter text.
    width = np.minimum(per, WORDS)
    many = np.where(per > 0, per - width + 1, 0)
    owner = np.repeat(np.arange(n_docs), many)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + first[owner]
    h = np.zeros(len(owner), np.uint64)
    for k in range(WORDS):
        use = k < width[owner]
        h = np.where(use, h * _Q + words[np.minimum(at + k, len(words) - 1)], h)
    h = _mix(h + width[owner].astype(np.uint64))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]
    return h[keep], owner[keep]


def _texts(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each value ends."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets[1:] - offsets[0]


def _band(n: np.ndarray) -> np.ndarray:
    return np.frexp(n.astype(np.float64))[1] - 1


def _most_different(n: np.ndarray, partner: np.ndarray) -> np.ndarray:
    """The largest symmetric difference that sets of these sizes may have at Jaccard 0.8."""
    return (n + partner) // 9


def sketch_keys(h: np.ndarray, owner: np.ndarray, sizes: np.ndarray, up: bool, hot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, documents, numbers in the document's order from 0) of each document's band or, with ``up``, of the next band for those near it.

    ``hot`` holds a bit for each slot whose keys go last; without it, the keys of all places with shingles.
    """
    band = _band(np.maximum(sizes, 1)) + (1 if up else 0)
    top = (2 << band.astype(np.int64)) - 1
    # The largest partner within the band: |B| <= 1.25 |A|.
    partner = np.minimum(sizes * 5 // 4, top)
    use = (sizes > 0) & ((partner >= 1 << band) if up else True)
    pick = use[owner]
    h, owner = h[pick], owner[pick]
    places = np.maximum(2, np.ceil(top * PLACES_PER_SHINGLE)).astype(np.int64)
    # More places than may differ, for the smallest bands too; the same in the whole band.
    places = np.maximum(places, 2 * top // 9 + 1)
    place = (_mix(h ^ _U(0x5851F42D4C957F2D)) >> _U(11)).astype(np.int64) % places[owner]
    order = np.lexsort((place, owner))
    place, owner, h = place[order], owner[order], h[order]
    if not len(h):
        return np.zeros(0, np.uint64), owner, owner
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])
    value = np.bitwise_xor.reduceat(_mix(h + _U(0x632BE59BD9B4E019)), first)
    place, owner = place[first], owner[first]
    level = _mix(np.arange(64, dtype=np.uint64) * _Q)
    name = lambda v, p, o: _mix(_mix(v + p.astype(np.uint64) * _U(0xD6E8FEB86659FD93)) + level[band[o]])
    keys = name(value, place, owner)
    filled = np.bincount(owner, minlength=len(sizes))
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(filled) - filled, filled)
    if hot is None:
        return keys, owner, rank
    slot = keys & _U(SLOTS - 1)
    late = hot[slot >> _U(5)] >> (slot & _U(31)).astype(np.uint32) & np.uint32(1)
    order = np.argsort(owner * 2 + late, kind="stable")
    place, owner, keys = place[order], owner[order], keys[order]
    send = _most_different(sizes, partner) + 1
    keep = rank < send[owner]
    lacks = np.flatnonzero(use & (filled < send))
    taken = {d: place[owner == d] for d in lacks.tolist()}
    owner, keys, rank = owner[keep], keys[keep], rank[keep]
    # A set that fills too few places also sends its first empty ones.
    for d, own in taken.items():
        free = np.setdiff1d(np.arange(places[d]), own)[: send[d] - filled[d]]
        more = np.full(len(free), d)
        owner, keys = np.r_[owner, more], np.r_[keys, name(np.zeros(len(free), np.uint64), free, more)]
        rank = np.r_[rank, filled[d] + np.arange(len(free))]
    return keys, owner, rank


def bit_sketch(h: np.ndarray) -> np.ndarray:
    """A parity bit for each place of a power of two of at least twice as many places as shingles (64 FOLD at least), in 64-bit words."""
    bits = max(64 * FOLD, 1 << int(max(2 * len(h), 1) - 1).bit_length())
    counts = np.bincount((h & _U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _folded(a: str, b: str) -> str:
    """SQL: sketch ``a`` cut to the size of ``b`` if it is larger, its halves laid over each other (a place is a hash's low bits)."""
    half = f"cast(size({a}) / 2 as int)"
    return f"if(size({a}) > size({b}), zip_with(slice({a}, 1, {half}), slice({a}, {half} + 1, {half}), (p, q) -> p ^ q), {a})"


#: SQL: false only if sizes (within a factor of 1.25, so that one fold is enough) or sketches prove a Jaccard similarity under 0.8.
_MAY_LINK = f"""5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b) AND 9 * aggregate(zip_with(
  {_folded("sketch_a", "sketch_b")}, {_folded("sketch_b", "sketch_a")}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x) <= n_a + n_b"""


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


_PRINTS = _U(0x2545F4914F6CDD1D), _U(0x9FB21C651E98DF25)


def _print(h: np.ndarray, cut: np.ndarray, salt: np.uint64) -> np.ndarray:
    """A 64-bit fingerprint of each set."""
    sums = np.r_[_U(0), np.cumsum(_mix(h ^ salt), dtype=np.uint64)]
    return _mix(sums[cut[1:]] - sums[cut[:-1]] + np.diff(cut).astype(np.uint64))


def document_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (set size), hi and lo (the set's fingerprint), sketch: one narrow row a document.

    Rows with a slot instead hold a task's counts (two at least) of the keys in that slot.
    """
    names = ["doc_id", "n", "hi", "lo", "sketch", "slot", "many"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.uint8)
        for batch in slices(batches, most=1 << 19):
            h, owner = shingle_sets(*_texts(batch))
            sizes = np.bincount(owner, minlength=batch.num_rows)
            cut = np.r_[0, np.cumsum(sizes)]
            prints = [_print(h, cut, salt) for salt in _PRINTS]
            sketches = [bit_sketch(h[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            for up in (False, True):
                keys = sketch_keys(h, owner, sizes, up)[0]
                at, n = np.unique(keys & _U(SLOTS - 1), return_counts=True)
                at = at.astype(np.int64)
                counts[at] = np.minimum(counts[at] + n, 255)
            none = [pa.nulls(batch.num_rows, pa.int32())] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), _signed(prints[0]), _signed(prints[1]), pa.array(sketches, kinds[4]), *none], names=names
            )
        at = np.flatnonzero(counts > 1)
        for k in range(0, len(at), 100_000):
            part = at[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(part), t) for t in kinds[:5]), pa.array(part, pa.int32()), pa.array(counts[part], pa.int32())], names=names)

    return map_arrow(texts_of(docs, id_col, text_col), run, "doc_id long, n long, hi long, lo long, sketch array<long>, slot int, many int")


def hot_slots(counted: DataFrame) -> np.ndarray:
    """The bit set of slots (SLOTS / 32 words) with high counts; it decides an order only, never a result."""
    by_slot = counted.where("slot IS NOT NULL").groupBy("slot").agg(F.sum("many").alias("many"))
    mean = (by_slot.agg(F.sum("many")).first()[0] or 0) / SLOTS
    words = by_slot.where(F.col("many") >= HOT + 2 * mean)
    words = words.select(F.expr("shiftright(slot, 5)").alias("w"), F.expr("shiftleft(1L, slot & 31)").alias("bit"))
    return _bit_set(words, SLOTS)


def _bit_set(words: DataFrame, size: int) -> np.ndarray:
    """w (number of a word of 32 bits), bit -> the words; at most size / 32 rows reach the driver."""
    found = words.groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(size // 32, np.uint32)
    bits[found.column("w").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return bits


def document_keys(docs: DataFrame, hot: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, node (the set's 64-bit name), own (the key is of the set's own band), rank (its number in the set's order).

    Copies of a set in different slices repeat its rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 19):
            h, owner = shingle_sets(*_texts(batch))
            sizes = np.bincount(owner, minlength=batch.num_rows)
            node = _print(h, np.r_[0, np.cumsum(sizes)], _PRINTS[0])
            # Copies of a set within the slice send their keys once.
            _, at = np.unique(node, return_index=True)
            once = np.zeros(batch.num_rows, bool)
            once[at] = True
            pick = once[owner]
            for up in (False, True):
                keys, who, rank = sketch_keys(h[pick], owner[pick], np.where(once, sizes, 0), up, held.value)
                parts = [_signed(keys), _signed(node[who]), pa.array(np.full(len(keys), not up)), pa.array(rank, pa.int32())]
                yield pa.RecordBatch.from_arrays(parts, names=["key", "node", "own", "rank"])

    return map_arrow(texts_of(docs, id_col, text_col), run, "key long, node long, own boolean, rank int")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, label (the smallest node that it reaches) for the nodes of ``edges`` (a, b).

    Each round takes the smallest label among a node and its neighbours and then the label of
    that label, so that the distance covered doubles; the labels are written every round.
    """
    both = scratch_table(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    labels = scratch_table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = scratch_table(step.join(jump, "label").select("node", "old", F.least("label", "further").alias("label")), "labels")
        labels = step.select("node", "label")
        if not step.where("old <> label").limit(1).count():
            return labels
    raise RuntimeError(f"no end after {rounds} rounds")


def _sketched(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a < b, of classes' documents) whose sizes and bit sketches allow a link."""
    named = lambda s: classes.select(F.col("doc").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))

    return pairs.join(named("a"), "a").join(named("b"), "b").where(_MAY_LINK).select("a", "b")


_FOLDED = f"transform(sequence(0, {FOLD - 1}), j -> aggregate(filter(sketch, (x, i) -> i % {FOLD} = j), 0L, (s, x) -> s ^ x))"
_FOLD_NEAR = "9 * aggregate(zip_with(fold, other_fold, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x) <= n + other_n"

#: Bits of the filter that keeps most texts without a candidate out of the verifying joins.
FILTER_BITS = 1 << 22


def _asked_for(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``texts`` of the documents in ``ids`` and a few others: a bit set of a fixed size, whatever the input.

    It only spares shuffling; the joins that follow decide. Once most bits are set it spares nothing.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = ids.select((place / 32).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {FILTER_BITS}) % 32 as int))").alias("bit"))
    bits = _bit_set(words, FILTER_BITS)
    held = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("place").to_numpy()
            keep = held.value[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1) == 1
            yield batch.select(["doc_id", "text"]).filter(pa.array(keep))

    return map_arrow(texts.where("doc_id IS NOT NULL").select("doc_id", "text", place.alias("place")), run, "doc_id long, text string")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) with a Jaccard similarity of at least 0.8."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    texts = _asked_for(texts, ids)
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", "text_b", most=1 << 19):
            sets = []
            for column in ("text_a", "text_b"):
                h, owner = shingle_sets(*_texts(batch, column))
                sets.append(np.split(h, np.cumsum(np.bincount(owner, minlength=batch.num_rows))[:-1]))
            keep = []
            for x, y in zip(*sets, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= 80 * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wide = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    # Repeated rows of a document repeat its pairs.
    return map_arrow(wide, run, "a long, b long").distinct()


_NEAR = "5 * least(n, other_n) >= 4 * greatest(n, other_n)"
#: SQL: the key may be the first one that two sets share if they are linked (so it is for at least one key of a linked pair).
_FIRST = "9 * greatest(rank, other_rank) <= n + other_n AND NOT arrays_overlap(before, other_before)"


def _labelled(shared: DataFrame, label: DataFrame | None) -> DataFrame:
    """``shared`` with each set's component and the component that most sets of the key are in; keys within one component are left out."""
    if label is None:
        here = shared.withColumn("label", F.col("doc"))
    else:
        here = shared.join(label.withColumnRenamed("node", "doc"), "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    here = here.withColumn("same", F.expr("count(*) OVER (PARTITION BY key, label)"))
    here = here.withColumn("mixed", F.expr("min(label) OVER (PARTITION BY key) < max(label) OVER (PARTITION BY key)")).where("mixed").drop("mixed")
    return here.withColumn("most", F.expr("max(struct(same, label)) OVER (PARTITION BY key).label")).drop("same")


def _tries(here: DataFrame, k: int) -> DataFrame:
    """a, b: every set with another of its keys in another component: round 0 the smallest one, then the
    neighbours in an order of the round. One partner from all of a set's keys in round 0, else up to three."""
    place = "doc" if k == 0 else f"xxhash64(doc, {k})"
    before = "first_value" if k == 0 else "lag"
    seen = here.select("doc", "n", "label", F.expr(f"{before}(struct(doc, n, label)) OVER (PARTITION BY key ORDER BY {place}, doc)").alias("o"))
    seen = seen.select("doc", "n", "label", F.col("o.doc").alias("other"), F.col("o.n").alias("other_n"), F.col("o.label").alias("other_label"))
    pairs = seen.where(f"label <> other_label AND {_NEAR}").groupBy("doc").agg(F.array_sort(F.collect_set("other")).alias("others"))
    some = F.slice("others", 1, 1 if k == 0 else 3)
    pairs = pairs.select("doc", F.explode(some).alias("other"))
    return pairs.select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).distinct()


def _shared_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The texts, the documents' sets, the classes (hi, lo, doc, n, sketch) and the keys of several classes (key, doc, n, own, rank)."""
    texts = texts_of(docs, id_col, text_col)
    counted = scratch_table(document_sets(docs, id_col, text_col), "shingle_sets")
    sets = counted.where("slot IS NULL").drop("slot", "many")
    classes = scratch_table(
        sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("hi", "lo").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("sketch").alias("sketch")),
        "shingle_classes",
    )
    # One exchange by key: the distinct rows and the window both use it.
    keys = document_keys(docs, hot_slots(counted), id_col, text_col).repartition("key").distinct()
    shared = keys.withColumn("many", F.expr("count(*) OVER (PARTITION BY key)")).where("many > 1").drop("many")
    shared = scratch_table(shared, "shared_keys")
    # From a set's 64-bit name to its class: sets that share a name are classes of their own from here on.
    shared = scratch_table(shared.join(classes.select(F.col("hi").alias("node"), "doc", "n"), "node").select("key", "doc", "n", "own", "rank"), "shared_keys")
    return texts, sets, classes, shared


def _meetings(here: DataFrame, classes: DataFrame, of: str, once: str) -> DataFrame:
    """a, b: pairs of sets with a key in common, by SQL conditions on a row (``of``) and on the pair (``once``).

    A pair whose sizes and folds allow a link comes from the first key that it shares, and again only
    from keys that come more than BEFORE keys after one that it shares.
    """
    before = f"collect_list(key) OVER (PARTITION BY doc, own ORDER BY rank, key ROWS BETWEEN {BEFORE} PRECEDING AND 1 PRECEDING)"
    here = here.join(classes.select("doc", F.expr(_FOLDED).alias("fold")), "doc").withColumn("before", F.expr(before))
    here = scratch_table(here, "folded_keys")
    other = here.where(of).select("key", F.col("doc").alias("other"), *(F.col(c).alias(f"other_{c}") for c in here.columns if c not in ("key", "doc", "most")))
    pairs = other.join(here, "key").where(F.expr(f"({once}) AND (own OR other_own) AND {_NEAR} AND {_FIRST} AND {_FOLD_NEAR}"))
    return pairs.select(F.least("other", "doc").alias("a"), F.greatest("other", "doc").alias("b"))


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """a, b (a < b): every pair of classes with a Jaccard similarity of at least 0.8, also within components.

    A class is named by the smallest doc_id of the documents with its set. The rows may be as many
    as the square of a group's classes; documents of one class are linked without a row.
    """
    texts, _, classes, shared = _shared_keys(docs, id_col, text_col)
    pairs = _meetings(shared, classes, "true", "other < doc").distinct()
    return _verified(scratch_table(_sketched(pairs, classes), "all_pairs"), texts)


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, tree_links.

    tree_links counts the links found between the document's class and others, enough to
    join its component; links between classes that are in one component already are not all
    looked for. ``jaccard_links`` gives all of them.
    """
    texts, sets, classes, shared = _shared_keys(docs, id_col, text_col)
    links, label = None, None
    for k in range(ROUNDS):
        pairs = scratch_table(_sketched(_tries(_labelled(shared, label), k), classes), "tried_pairs")
        found = scratch_table(_verified(pairs, texts), "tried_links")
        links = found if links is None else links.union(found)
        label = components(links)
    # Then all pairs of a key that lie in different components.
    here = scratch_table(_labelled(shared, label), "labelled_keys")
    rest = _meetings(here, classes, "label <> most", "label <> other_label AND (label = most OR other < doc)").distinct()
    more = _verified(scratch_table(_sketched(rest, classes), "other_pairs"), texts)
    links = scratch_table(links.union(more).distinct(), "all_links")
    label = components(links).select(F.col("node").alias("doc"), F.col("label").alias("component_id"))
    degree = links.select(F.col("a").alias("doc")).union(links.select("b")).groupBy("doc").agg(F.count(F.lit(1)).alias("tree_links"))
    named = classes.select("hi", "lo", "doc").join(label, "doc", "left").join(degree, "doc", "left")
    named = named.select("hi", "lo", F.coalesce("component_id", "doc").alias("component_id"), F.coalesce("tree_links", F.lit(0)).alias("tree_links"))
    filled = F.col("n") > 0
    return sets.join(named, ["hi", "lo"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(filled, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(filled, F.coalesce("tree_links", F.lit(0))).otherwise(F.lit(0)).alias("tree_links"),
    )


SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 80 * (p.n + q.n - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(max(s.n), 0) AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
"""
