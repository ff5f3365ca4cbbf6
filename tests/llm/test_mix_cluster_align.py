"""Source mixing, Shallot k-means and token alignment against brute force and odd tables."""

import hashlib
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from riskfabric.llm import pivotal_mix, shallot_kmeans, token_align

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    (1, None, "b"), (2, "", "b"), (3, " \n\t ", None), (4, "The same text, twice.", "a"), (4, "The same text, twice.", "a"), (None, "no id and some words", "a"),
    (5, "x" * 30_000, "c"), (6, "a b " * 9_000, "a"), (7, "<|endoftext|> in <s> text </s> <0x41> <unk>", "ä"), (8, "naïve Straße ² ½ 中文 😀 é Σας", "😀"),
    (9, "a mark ▁ in a text", "b"), (10, "  leading   and trailing  ", ""), (11, "tab\tand no-break\u0085space \x00 end", "b"), (12, "one", "only"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, s, 7, 1.5, {"k": "v"}) for i, t, s in ODD]
    # Columns with names that the operators use inside.
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size long, target double, block map<string,string>").repartition(3)


def words(text):
    return len([w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w])


def level_targets(sizes, most=3, weights=(1, 2, 3)):
    """The excess is shared again until no target is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full, out = sum(sizes.values()), set(), {}
    while True:
        rest, share = total - sum(most * sizes[s] for s in full), sum(weight[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else rest * weight[s] / share for s in names}
        over = {s for s in names if out[s] > most * sizes[s]}
        if not over:
            return out
        full |= over


def check_mix(rows, docs, most=3):
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += words(text)
    want = level_targets(sizes, most)
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in rows) == Counter((i, words(t), s) for i, t, s in docs)
    taken = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-12, abs_tol=1e-9)
        assert 0 <= r["taken"] == r["copies"] * r["size"] + r["part"] <= most * r["size"] and r["part"] <= r["size"]
        assert r["copies"] in (int(r["target"] / max(r["source_size"], 1)), int(r["target"] / max(r["source_size"], 1)) + 1)
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert all(n <= 1 for n in Counter(r["source"] for r in rows if r["part"]).values())


def test_mix_odd_rows_and_reruns(odd):
    first = pivotal_mix.mix(odd).collect()
    check_mix(first, ODD)
    again = pivotal_mix.mix(odd.repartition(7, "text")).collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))
    assert pivotal_mix.mix(odd.where("doc_id < 0")).count() == 0
    only = pivotal_mix.mix(odd.where("text IS NULL")).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in only] == [(0, 0.0, 0)]


def test_mix_through_several_levels(spark, monkeypatch):
    monkeypatch.setattr(pivotal_mix, "LEAF", 8)
    monkeypatch.setattr(pivotal_mix, "FAN", 3)
    monkeypatch.setattr(pivotal_mix, "CHUNK", 50)
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(["w"] * int(rng.integers(0, 40))), "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    docs += [(7_000, "equal rows of a text", "hot")] * 333 + [(8_000, "long " * 4_000, "s0")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    check_mix(pivotal_mix.mix(df).collect(), docs)


def test_pivot_keeps_the_sum_and_the_odds():
    room = np.array([5, 9, 2, 7, 4, 30, 1, 8], np.int64) * 1000
    mass = (room * 0.3).astype(np.int64)
    mass[1], mass[4] = 0, room[4]
    hits = np.zeros(len(room))
    for s in range(6_000):
        after = pivotal_mix.pivot(mass, room, np.random.default_rng(s))
        assert after.sum() == mass.sum() and ((after > 0) & (after < room)).sum() <= 1 and (after >= 0).all() and (after <= room).all()
        hits += after / room
    assert np.allclose(hits / 6_000, mass / room, atol=0.03)


def test_mixed_rows_are_the_plan(odd):
    got = pivotal_mix.mixed(odd)
    assert got.columns == odd.columns
    counts = Counter()
    for r in got.collect():
        counts[r["doc_id"], r["source"]] += words(r["text"])
    want = Counter()
    for r in pivotal_mix.mix(odd).collect():
        want[r["doc_id"], r["source"]] += r["taken"]
    assert {k: v for k, v in counts.items() if v} == {k: v for k, v in want.items() if v}


def plain_kmeans(vectors, k, rounds, scale, seed, dim):
    """All pairs, in Python's integers."""
    kept = [(i, [math.floor(x * scale) if abs(x) < 2**40 else int(x) * scale for x in map(float, v)]) for i, v in vectors if v and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((v for v in kept if v[0] is not None), key=lambda v: (hashlib.sha256(f"{seed}:{v[0]}".encode()).hexdigest(), v[1])) + sorted(v for v in kept if v[0] is None)
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            members = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if members:
                centroids[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    return sorted([(i, nearest(v)[1], min(nearest(v)[0], 2**63 - 1)) for i, v in kept], key=lambda r: (r[0] is None, r)), centroids


def vectors_of(rng, n, dim, centres, spread):
    c = rng.normal(size=(centres, dim))
    return (c[rng.integers(0, centres, n)] + rng.normal(size=(n, dim)) * spread).astype(np.float32).tolist()


@pytest.mark.parametrize(("n", "dim", "centres", "spread", "k"), [(400, 6, 9, 0.1, 12), (300, 3, 2, 0.004, 20), (150, 64, 5, 0.5, 40), (7, 4, 3, 0.3, 40), (60, 2, 4, 0.2, 1)])
def test_kmeans_equals_all_pairs(spark, n, dim, centres, spread, k):
    rng = np.random.default_rng(n)
    data = list(enumerate(vectors_of(rng, n, dim, centres, spread)))
    data += [(5, data[3][1]), (n + 1, data[4][1]), (None, data[2][1])]  # repeated identifier, equal vectors, no identifier
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in data], "vec_id long, embedding array<float>, cluster int, point string").repartition(4)
    rows, centroids = shallot_kmeans.kmeans(df, k=k, rounds=4, dim=dim)
    want, ends = plain_kmeans(data, k, 4, 256, 2, dim)
    assert centroids == ends
    assert sorted(map(tuple, rows.collect()), key=lambda r: (r[0] is None, r)) == want


def test_kmeans_odd_vectors(spark):
    rng = np.random.default_rng(2)
    data = list(enumerate(vectors_of(rng, 40, 4, 3, 0.2)))
    data += [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0, 3.0]), (104, [1.0, float("nan"), 2.0, 3.0]), (105, [float("inf")] * 4), (106, [0.0] * 4)]
    wide = [(200, [1e6, -1e6, 5.0, 0.25]), (201, [3e30, 1.0, 2.0, 3.0]), (202, [1e6, -1e6, 6.0, 0.25])]
    for extra in ([], wide):
        df = spark.createDataFrame(data + extra, "vec_id long, embedding array<float>")
        rows = shallot_kmeans.clusters(spark, df, k=6, rounds=3, dim=4).collect()
        exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in data + extra]
        want, ends = plain_kmeans(exact, 6, 3, 256, 2, 4)
        assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in rows) == want
        for r in rows:
            assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, ends[r["cluster"]])).encode()).hexdigest()
            assert r["cluster_inertia"] == min(sum(w[2] for w in want if w[1] == r["cluster"]), 2**63 - 1)
            assert r["inertia"] == min(sum(w[2] for w in want), 2**63 - 1)
    assert shallot_kmeans.clusters(spark, spark.createDataFrame(data, "vec_id long, embedding array<float>").where("vec_id < 0")).count() == 0


def test_bounds_skip_most_distances(spark):
    """With clear clusters few vectors are measured after the first round."""
    rng = np.random.default_rng(9)
    points = (np.array(vectors_of(rng, 3_000, 8, 10, 0.05)) * 256).astype(np.int64)
    start = [points[i].tolist() for i in range(10)]
    search = shallot_kmeans.Search(start, None)
    first, second, d1, d2 = search.all(points)
    asked = []
    after = [[x + 1 for x in c] for c in start]
    search = shallot_kmeans.Search(after, start)
    measured = search.squared
    search.squared = lambda x, at: (asked.append(len(x)), measured(x, at))[1]
    at = np.arange(len(points))
    cluster, distance = first.copy(), np.zeros(len(points), np.int64)
    shallot_kmeans._bounded(search, points, at, cluster, second.copy(), np.sqrt(d1), np.sqrt(d2), distance, False)
    assert (cluster == search.all(points)[0]).all()
    assert sum(asked) < len(points) * 5  # all pairs are 10 a vector


def plain_alignment(texts):
    """Token by token, with the libraries alone."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(BYTE), SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    letters = token_align.byte_letters()

    def ranges(ids, tokens):
        at, out = 0, []
        for i, t in zip(ids, tokens, strict=True):
            out.append((i, at, at + len(t)))
            at += len(t)
        return out

    found, count = [], Counter()
    for t in texts:
        if not t:
            found.append(([], [], []))
            continue
        ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
            found.append(([], [], []))
            continue
        ra, rb = ranges(ids_a, bytes_a), ranges(ids_b, bytes_b)
        by_end = {e: i for i, _, e in rb}
        links = [(i, by_end[e], e) for i, _, e in ra if e in by_end]
        count.update((x, y) for x, y, _ in links)
        found.append((ra, rb, links))
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    rows = []
    for ra, rb, links in found:
        groups, at = [], 0
        for _, _, e in links:
            groups.append(",".join(str(i) for i, _, x in ra if at < x <= e) + "|" + ",".join(str(i) for i, _, x in rb if at < x <= e))
            at = e
        over = 0
        for _, s, e in ra if len(ra) < 3_000 else []:
            over += sum(1 for _, s2, e2 in rb if s2 < e and s < e2)
        rows.append((
            len(ra), len(rb), len(links), len(links), sum(count[x, y] == most[y] for x, y, _ in links), sum(count[x, y] for x, y, _ in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if ra else "", over,
        ))
    return rows


@pytest.mark.parametrize("block", [1 << 21, 200])
def test_alignment_equals_plain(odd, monkeypatch, block):
    # The block's size reaches the tasks as a default, so small blocks are set where slices are cut.
    cut = token_align.slices
    monkeypatch.setattr(token_align, "slices", lambda batches, most: cut(batches, most=block))
    docs = [d for d in ODD if not d[1] or len(d[1]) < 10_000]
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256 n_overlaps".split()
    got = token_align.align(odd.where("text IS NULL OR length(text) < 10000"), BYTE, PIECE).collect()
    want = [(i, *r) for (i, _, _), r in zip(docs, plain_alignment([t for _, t, _ in docs]), strict=True)]
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter(want)


def test_alignment_of_long_texts_and_none(odd):
    got = {r["doc_id"]: r for r in token_align.align(odd, BYTE, PIECE).collect()}
    want = dict(zip([i for i, _, _ in ODD], plain_alignment([t for _, t, _ in ODD]), strict=True))
    for i in (5, 6):
        assert (got[i]["n_a"], got[i]["n_b"], got[i]["n_groups"], got[i]["groups_sha256"]) == (want[i][0], want[i][1], want[i][2], want[i][6])
    assert got[1]["n_a"] == got[2]["n_b"] == got[9]["n_links"] == 0 and got[9]["groups_sha256"] == ""
    assert token_align.align(odd.where("doc_id < 0"), BYTE, PIECE).count() == 0


def test_alignment_covers_documents(spark):
    """Groups of real texts hold all tokens, and counts over the corpus add up."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = token_align.align(docs, BYTE, PIECE).agg(F.sum("n_links"), F.sum("count_sum"), F.min("n_groups"), F.sum(F.col("n_best"))).first()
    plain = plain_alignment([r["text"] for r in docs.select("text").collect()])
    assert (got[0], got[1], got[3]) == (sum(r[3] for r in plain), sum(r[5] for r in plain), sum(r[4] for r in plain))
