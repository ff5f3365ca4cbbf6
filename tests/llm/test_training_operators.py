"""The training-data operators against brute force, round trips and odd tables."""

import hashlib
import itertools
import math
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from riskfabric.llm import (
    elias_fano,
    exact_sort,
    harmonic_pack,
    license_index,
    parity_join,
    pii_crf,
    piece_rounds,
    posting_ann,
    token_counts,
    toxicity,
    word_cache,
)

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")

BASE = " ".join(f"word{i}" for i in range(60))
#: Nulls, empty and white texts, ties, repeated rows, a long text, special strings, other scripts.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "The same Text"), (5, "the SAME text"), (5, "the SAME text"), (None, "no id"),
    (6, BASE), (7, BASE + " more"), (8, BASE.upper()), (9, "x" * 30_000), (10, "a b " * 4_000),
    (11, "<|endoftext|> in <|startoftext|> text </s>"), (12, "naïve Straße İstanbul ² ½ 中文 😀 é Σας ΟΔΟΣ"), (13, "ÉCOLE école"), (14, "École École"),
    (15, "mail a.b+c@mail.example.com, 10.20.30.40, 4111 1111 1111 1111, +1 (212) 555-0100."),
    (16, "Released under the MIT License. Licensed under the Apache License, Version 2.0. GNU general public\nlicense, version 3"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", 1, True, f"p{k}") for k, (i, t) in enumerate(ODD)]
    # Columns with names that operators use inside.
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n long, kept boolean, _prefix string").repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id < 0")


def by_id(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def norm(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_content_groups(odd, none):
    groups = {}
    for i, t in ODD:
        groups.setdefault(norm(t), []).append(i)
    got = exact_sort.content_groups(odd, tasks=40).collect()
    assert len(got) == len(ODD)
    for r in got:
        own = next(v for k, v in groups.items() if hashlib.sha256(k.encode()).hexdigest() == r["text_sha256"] and r["doc_id"] in v)
        assert (r["keep_id"], r["group_size"]) == (max((x for x in own if x is not None), default=None), len(own))
    assert sum(r["kept"] for r in got) == len(groups)
    assert exact_sort.content_groups(none).count() == 0


def test_keep_one_keeps_columns(odd, none):
    kept = exact_sort.keep_one(odd, tasks=40)
    assert kept.columns == odd.columns
    assert kept.count() == len({norm(t) for _, t in ODD})
    assert {r["doc_id"] for r in kept.collect()} >= {2, 3, 5, 8, 9}
    assert exact_sort.keep_one(none).count() == 0


@pytest.mark.parametrize("digest", [True, False])
@pytest.mark.parametrize("tasks", [2, 60])
def test_comparisons_decide_what_is_equal(spark, monkeypatch, digest, tasks):
    """Heavy texts are cut, and all texts may even share one digest: neighbours are compared in full."""
    if not digest:
        monkeypatch.setattr(exact_sort, "_digest", lambda norm: F.lit("same"))
    same = "a passage that all of these texts begin with, and that is longer than a prefix "
    texts = [(i, same + "copies of one text") for i in range(300)] + [(7, same + "Copies of one text")] * 20
    texts += [(1000 + i, same + f"text {i % 60}") for i in range(200)] + [(None, same + "text 3"), (5000, None), (5001, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    groups = {}
    for i, t in texts:
        groups.setdefault(norm(t), []).append(i)
    want = sorted(((i, max((x for x in groups[norm(t)] if x is not None), default=None), len(groups[norm(t)])) for i, t in texts), key=str)
    got = exact_sort.content_groups(df, tasks=tasks).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=str) == want
    assert sum(r["kept"] for r in got) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    kept = exact_sort.keep_one(df, tasks=tasks).collect()
    assert sorted(norm(r["text"]) for r in kept) == sorted(groups)
    assert {r["doc_id"] for r in kept} == {max(x for x in g if x is not None) for g in groups.values()}


def encoded(path, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("path", "lower", "specials"), [(BYTE, False, word_cache.BYTE_SPECIALS), (WORD, True, word_cache.LOWER_SPECIALS)])
def test_word_cache_equals_the_library(path, lower, specials):
    cache = word_cache.word_cache(path, lower, specials)
    safe = [chr(c) for c in range(0x2100) if word_cache._SAFE.fullmatch(chr(c))]
    texts = [t or "" for _, t in ODD]
    # Every character that the expressions cut by themselves, next to letters, digits, signs and white space.
    texts += [f"a{c}b 1{c}2 ,{c}. {c}{c} \n{c}  {c}'s{c}" for c in safe]
    expected = cache.tokenizer.encode_batch(texts, add_special_tokens=False)
    for t, ids, e in zip(texts, cache.encode(texts), expected, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == e.ids, t[:40]


def test_token_counts(odd, none):
    got = by_id(token_counts.count_tokens(odd, BYTE, 1000), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = [(i, len((t or "").encode()), len(encoded(BYTE, t)), len(encoded(BYTE, t)) > 1000) for i, t in ODD]
    assert got == sorted(want, key=lambda r: tuple((x is not None, x) for x in r))
    assert token_counts.count_tokens(none, BYTE).count() == 0


def test_whole_tokens_are_single():
    proven = token_counts.whole_tokens(BYTE)
    assert " the" in proven and 20_000 < len(proven) < 50_257
    assert all(len(encoded(BYTE, w)) == 1 for w in sorted(proven)[::2500])


def test_elias_fano_select():
    rng = np.random.default_rng(1)
    for gaps in (rng.integers(1, 9, 2_000), rng.integers(0, 100_000, 700), np.r_[np.ones(600, int), 10**9, np.ones(600, int)], np.ones(1, int), rng.integers(0, 2, 3_000), np.zeros(300, int)):
        ends = np.cumsum(gaps)
        low, lows, highs = elias_fano.encode_bounds(ends)
        ef = elias_fano.EliasFano(len(ends), low, lows, highs)
        assert [ef.select(i) for i in range(len(ends))] == ends.tolist()
        for a, b in [sorted(rng.integers(0, len(ends) + 1, 2)) for _ in range(40)] + [(0, len(ends))]:
            assert ef.block(a, b).tolist() == ends[a:b].tolist()
        assert len(lows) + len(highs) <= len(ends) * (4 + math.log2(ends[-1] / len(ends) + 1)) / 8 + 4
        assert ef.samples.nbytes <= len(ends) / 64 + 4


@pytest.mark.parametrize("ids", [[None, None, -(2**63), -5, 0, 7, 7, 2**63 - 1], [3], [None], list(range(1000, 90_000, 97)), [None] * 3 + [5] * 400])
def test_shard_in_memory(ids):
    import io

    docs = [np.arange(k % 5 + 1, dtype="<u2").tobytes() for k in range(len(ids))]
    data = elias_fano.shard_bytes(ids, docs, 2)
    shard = elias_fano.Shard(io.BytesIO(data))
    assert [shard.ident(i) for i in range(shard.n)] == ids
    for a in range(0, len(ids), 300):
        names, start, parts = shard.documents(a, min(a + 300, len(ids)))
        assert names == ids[a : a + 300] and start == sum(len(d) for d in docs[:a]) // 2
        assert [p.tobytes() for p in parts] == docs[a : a + 300]
    assert shard.document(len(ids) - 1).tobytes() == docs[-1]
    if len(ids) > 500:  # boundaries, identifiers and samples take few bytes a document
        assert len(data) - sum(map(len, docs)) < 3 * len(ids)


def test_shards_are_read_back_by_many_tasks(spark, tmp_path):
    docs = spark.range(200).selectExpr("id AS doc_id", "repeat('many words ', 30) AS text")
    out = str(tmp_path / "shards")
    manifest = elias_fano.write_shards(docs, BYTE, out, shard_size=1_000)
    read = elias_fano.read_shards(manifest, out)
    assert manifest.count() > 20 and read.count() == 200
    assert read.rdd.getNumPartitions() == manifest.count()


def test_width_is_checked(odd, tmp_path):
    with pytest.raises(Exception, match="1 bytes can't hold"):
        elias_fano.write_shards(odd, BYTE, str(tmp_path / "narrow"), width=1)


def test_shards_round_trip(spark, odd, none, tmp_path):
    rows = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    out = str(tmp_path / "shards")
    manifest = elias_fano.write_shards(rows, BYTE, out, shard_size=4_000)
    assert manifest.count() > 2
    got = by_id(elias_fano.read_shards(manifest, out), "doc_id", "start", "n_tokens", "ids_crc32")
    at, want = 0, []
    for i, t in sorted({i: t for i, t in ODD if i is not None}.items()):
        ids = [*encoded(BYTE, t), 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    assert elias_fano.encode_and_read(odd, BYTE).count() == len(ODD)
    assert elias_fano.encode_and_read(none, BYTE).count() == 0


def test_pieces_equal_the_library(odd, none):
    model = piece_rounds.model(PIECE)
    rng = np.random.default_rng(3)
    marks = list("aab  th ein▁\n\t.xyzé中😀<s>\x00\x85theaaa-==")
    texts = [t or "" for _, t in ODD] + ["".join(rng.choice(marks, rng.integers(0, 60))) for _ in range(400)] + ["ab" * 900, " " * 300]
    for t, ids in zip(texts, model.encode(texts), strict=True):
        assert ids.tolist() == [*model.library.encode(t), model.eos], t[:40]
    words = ["theinthere" * 20, "a" * 300]
    flat = [model.symbols(w) for w in words]
    merged, owner = model.merge_rounds(np.concatenate(flat), np.repeat([0, 1], [len(f) for f in flat]))
    assert [merged[owner == k].tolist() for k in (0, 1)] == [model.merge_heap(f.tolist()) for f in flat]
    for r in piece_rounds.encode_decode(odd, PIECE).collect():
        assert r["decoded"] == model.library.decode(list(r["ids"]))
    assert piece_rounds.encode_decode(none, PIECE).count() == 0


def test_packing(odd, none):
    got = harmonic_pack.pack(odd, WORD, ids=True, capacity=256).collect()
    tokens = {}
    for r in sorted(got, key=lambda r: (r["doc_id"] is not None, r["doc_id"], r["start"])):
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"] > 0
        tokens.setdefault(r["doc_id"], []).append(r)
    for i, t in ODD:
        times = sum(x == i for x, _ in ODD)
        assert sum(r["length"] for r in tokens[i]) == times * (len(encoded(WORD, t)) + 1)
    bins = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 256
    assert harmonic_pack.pack(none, WORD).count() == 0


def test_cuts_cover_and_fit():
    for n in (1, 2, 63, 64, 65, 100, 2047, 2048, 2049, 4095, 4096, 4097, 9_999):
        pieces = harmonic_pack.cuts(n)
        assert sum(p[1] for p in pieces) == n and all(j * m <= 4096 for j, m in pieces)


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", norm(text)) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                group[find(i)] = find(j)
    return [(r[0], len(s), min((rows[k][0] for k in range(len(rows)) if find(k) == find(i) and rows[k][0] is not None), default=None)) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]


def test_parity_join_is_exact(spark):
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for size in (4, 5, 6, 7, 9, 13, 20, 45, 120, 300):
        for _ in range(4):
            words = [f"w{x}" for x in rng.integers(0, 10_000, size + 4)]
            for edits in (0, 0, 1, 1, 2, 3, max(1, size // 25), max(1, size // 12)):
                own = list(words)
                for _ in range(edits):
                    k = int(rng.integers(0, 3))
                    if k == 0:
                        own[int(rng.integers(len(own)))] = f"e{rng.integers(10**6)}"
                    elif k == 1:
                        own.append(f"e{rng.integers(10**6)}")
                    elif len(own) > 1:
                        own.pop(0)
                rows.append((n, " ".join(own)))
                n += 1
    rows += [(n + 1, ""), (n + 2, None), (n + 3, " \t"), (n + 4, "one two"), (n + 5, "ONE\ttwo"), (n + 6, "two one")]
    rows += [(n + 10 + k, "shared passage " + " ".join(f"p{j}" for j in range(40)) + f" own{k} tail{k} end{k}") for k in range(30)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, key int").repartition(4)
    got = by_id(parity_join.jaccard_groups(df), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_components(rows))


def test_parity_join_emits_all_links(spark, none):
    rng = np.random.default_rng(12)
    rows = []
    for size, copies in ((8, 6), (30, 12), (60, 40), (200, 12)):  # groups of near copies, more than a tree's links each
        words = [f"w{x}" for x in rng.integers(0, 10_000, size)]
        for _ in range(copies):
            own = list(words)
            for k in range(int(rng.integers(0, 2 + size // 25))):
                own[-1 - k] = f"e{rng.integers(10**6)}"
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows), ""), (len(rows) + 1, None), (None, rows[0][1])]
    sets = {}
    for i, t in rows:
        if i is not None and shingles(t):
            sets.setdefault(frozenset(shingles(t)), i)
    near = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    want = sorted((min(sets[x], sets[y]), max(sets[x], sets[y])) for x, y in itertools.combinations(sets, 2) if near(x, y))
    assert len(want) > 5 * len(sets)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert by_id(parity_join.jaccard_links(df), "a", "b") == want
    assert parity_join.jaccard_links(none).count() == 0
    assert "n_links" not in parity_join.jaccard_groups(none).columns  # what it counts is no join's links


def test_parity_join_pair_comes_once(spark):
    """Texts of a group that are no links share many keys; their pairs come from the first of them, linked ones all the same."""
    rng = np.random.default_rng(21)
    rows = []
    for size, copies, edits in ((150, 30, 4), (400, 12, 2), (1500, 16, 24)):
        words = [f"w{x}" for x in rng.integers(0, 10_000, size)]
        for _ in range(copies):
            own = list(words)
            for k in rng.integers(0, size, edits):
                own[int(k)] = f"e{rng.integers(10**6)}"
            rows.append((len(rows), " ".join(own)))
    sets = [shingles(t) for _, t in rows]
    near = {(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    _, _, classes, shared = parity_join._shared_keys(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text")
    at_a_key = shared.alias("x").join(shared.alias("y"), "key").where("x.doc < y.doc AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)").count()
    came = [(r["a"], r["b"]) for r in parity_join._meetings(shared, classes, "true", "other < doc").collect()]
    assert near and near <= set(came) and len(set(came)) > 1.2 * len(near)
    assert at_a_key > 10 * len(set(came)) and len(came) < 3 * len(set(came))
    assert by_id(parity_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_shingles", "component_id") == sorted(brute_components(rows))


def test_parity_join_odd(odd, none):
    rows = [r for r in ODD if r[0] is not None]
    got = by_id(parity_join.jaccard_groups(odd).where("doc_id IS NOT NULL"), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_components(rows))
    assert parity_join.jaccard_groups(none).count() == 0


def base_by_patterns(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        g = [int(c) for c in m[0] if c in "0123456789"]
        if 13 <= len(g) <= 19 and (sum(g[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in g[-2::-2])) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(2)
    marks = list("aZ9@.. -+()%0123456789@._é٣\n")
    texts = [t or "" for _, t in ODD] + ["".join(rng.choice(marks, rng.integers(0, 80))) for _ in range(3_000)]
    texts += ["a@b.c@d.e.f@g", "1.2.3.4.5.6.7.8", "300.1.1.1 1.1.1.256", "4111-1111-1111-1111 4111111111111112", "@.a@b..c", "0" * 40]
    for t in texts:
        assert [(pii_crf.KINDS[k], a, b) for k, a, b in pii_crf.base_spans(t)] == base_by_patterns(t), t


def numeric_gradients(tagger, x, y, p, at, step=1e-2):
    old = float(p[at])
    p[at] = old + step
    up = tagger.gradients(x, y)[0]
    p[at] = old - step
    down = tagger.gradients(x, y)[0]
    p[at] = old
    return (up - down) / (2 * step)


def test_tagger_gradients_and_decoding():
    rng = np.random.default_rng(0)
    tagger = pii_crf.Tagger.start(rng, 4)
    x, y = rng.integers(0, pii_crf.CLASSES, (3, 7)), rng.integers(0, pii_crf.TAGS, (3, 7)).astype(np.int8)
    _, grads = tagger.gradients(x, y)
    for p, g in zip(tagger.parameters(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        assert numeric_gradients(tagger, x, y, p, at) == pytest.approx(float(g[at]), rel=0.05, abs=1e-3)
    # The decoded path is the best of all paths.
    import itertools

    tagger.trans[:] = rng.standard_normal(tagger.trans.shape)
    x = x[:1, :3]
    s = tagger.run(x)[0]
    score = lambda p: sum(s[t, k] for t, k in enumerate(p)) + sum(tagger.trans[a, b] for a, b in itertools.pairwise(p))
    assert tuple(tagger.decode(x)[0]) == max(itertools.product(range(pii_crf.TAGS), repeat=3), key=score)


@pytest.fixture(scope="module")
def tagger():
    rng = np.random.default_rng(9)
    texts = []
    for k in range(400):
        words = " ".join(rng.choice(["the", "report", "was", "sent", "to", "them", "and", "level", "of"], 30))
        digits = "".join(map(str, rng.integers(0, 10, 15)))
        card = next(digits + str(c) for c in range(10) if pii_crf.luhn(digits + str(c)))
        value = [f"{chr(97 + k % 26)}ob.{k}@mail{k % 9}.example.com", ".".join(map(str, rng.integers(0, 256, 4))), card, f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}"][k % 4]
        texts.append(f"{words} {value} {words} {k} {words}")
    return pii_crf.train(*pii_crf.training_windows(texts))


def test_tagger_finds_what_patterns_miss(tagger):
    found = pii_crf.method_spans(["please write to bob.77 @ mail3.example.com and the report was sent", "the level was sent to them and the report", ""], tagger)
    assert any(k == 0 for k, _, _ in found[0]) and not found[1] and not found[2]
    # Decoding in windows leaves no seams: the same span, at any place of a long text.
    for lead in (0, 40, 90, 95, 143, 1_000):
        base, both = pii_crf.all_spans(["x " * lead + "call +1 (212) 555-0100 now"], tagger)
        assert set(base[0]) <= set(both[0])


ADDRESSES = [
    "jane.doe (at) example (dot) com", "mary at example dot org", "john.smith [at] mail [dot] example [dot] net", "anna.lee at example.com", "peter(at)example.org",
]


@pytest.fixture(scope="module")
def plain_tagger():
    """Trained on addresses without digits among words that hold "at" and "dot"."""
    rng = np.random.default_rng(10)
    names, hosts = ["jane", "john", "mary", "peter", "anna", "lee", "smith", "doe", "brown"], ["example", "mail", "post", "school", "work"]
    texts = []
    for k in range(1200):
        words = [" ".join(rng.choice(["the", "report", "was", "sent", "to", "them", "at", "noon.", "and", "a", "dot", "level", "of", "look", "home"], 30)) for _ in range(3)]
        digits = "".join(map(str, rng.integers(0, 10, 15)))
        card = next(digits + str(c) for c in range(10) if pii_crf.luhn(digits + str(c)))
        mail = f"{'.'.join(rng.choice(names, rng.integers(1, 3)))}@{'.'.join(rng.choice(hosts, rng.integers(1, 3)))}.{rng.choice(['com', 'org', 'net'])}"
        value = [mail, mail, ".".join(map(str, rng.integers(0, 256, 4))), card, f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}"][k % 5]
        texts.append(f"{words[0]} {value} {words[1]} {k} {words[2]}")
    return pii_crf.train(*pii_crf.training_windows(texts))


@pytest.mark.parametrize("address", ADDRESSES)
def test_written_out_addresses_without_digits(plain_tagger, address):
    text = f"the report was sent to {address} and the level of them"
    spans = pii_crf.all_spans([text, "look at the report sent at noon and a dot of the level"], plain_tagger)[1]
    a = text.index(address)
    assert any(k == 0 and s < a + len(address) // 2 < e for k, s, e in spans[0]), spans
    assert "at" not in pii_crf.masked(text, spans[0]).split() and "EMAIL" in pii_crf.masked(text, spans[0])
    assert not spans[1]


def test_rewritten_addresses_get_no_digit():
    rng = np.random.default_rng(1)
    assert not any(c.isdigit() for _ in range(200) for c in pii_crf.noisy(0, "jane.doe@example.com", rng))


def test_sample_lies_around_spans(spark, none):
    lead = "version 1.2 of 3 May 2020 " * 100  # digits first, the span far behind
    rows = [(i, f"{lead} user{i}@mail.example.com {lead}") for i in range(60)] + [(100 + i, lead) for i in range(60)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = pii_crf.sample_pieces(docs).collect()
    assert sorted(r["doc_id"] for r in pieces) == list(range(60))
    assert all(f"user{r['doc_id']}@mail.example.com" in r["t"] and len(r["t"]) <= 900 for r in pieces)
    assert pii_crf.fit(docs) is not None


def test_pii_odd(odd, none, tagger):
    for r in pii_crf.find(odd, tagger).collect():
        text = next(t or "" for i, t in ODD if i == r["doc_id"])
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in base_by_patterns(text))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
        assert sum(r[f"n_{k}"] for k in pii_crf.KINDS) == len([s for s in r["spans"].split(",") if s])
    masked = {r["doc_id"]: r for r in pii_crf.mask(odd, tagger, length_col="n").collect()}
    assert "@" not in masked[15]["text"] and masked[15]["n"] == len(masked[15]["text"])
    assert masked[1]["text"] is None and masked[5]["text"] == "the SAME text" and masked[5]["n"] == 1
    assert pii_crf.find(none, None).count() == 0 and pii_crf.fit(none) is None


def test_licences(odd, none):
    got = {r["doc_id"]: r for r in license_index.scan(odd).collect()}
    assert license_index.scan(odd).count() == len(ODD)
    for i, t in ODD:
        words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", norm(t)) if w]
        starts = [k for p in license_index.BASE for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(starts), min(starts, default=None), max(starts, default=None))
    assert got[16]["base_labels"] == "apache,gpl,mit" and got[16]["labels"] == "apache,gpl,mit" and got[16]["score"] == 1.0
    assert (got[6]["labels"], got[6]["score"]) == ("", 0.0)
    assert license_index.scan(none).count() == 0


def test_licence_templates_without_base_phrase(spark):
    texts = [
        (1, "x y Redistribution and use in source and binary forms, with or without modification, are permitted z"),
        (2, "Redistribution of source forms is a modification that binary use has permitted"),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ]
    got = {r["doc_id"]: (r["labels"], r["base_labels"]) for r in license_index.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: ("bsd", ""), 2: ("", ""), 3: ("mit", "")}


def test_licence_files_with_many_notices(spark):
    texts = [t for _, t, _ in license_index.TEMPLATES]
    files = [(0, [3, 8, 1]), (1, [1, 8]), (2, list(range(len(texts)))), (3, list(range(len(texts)))[::-1])]
    files += [(10 + k, list(c)) for k, c in enumerate(itertools.combinations(range(len(texts)), 3))]
    rows = [(i, " ~ zz ~ ".join(texts[k] for k in ks)) for i, ks in files]
    got = {r["doc_id"]: set(r["labels"].split(",")) for r in license_index.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    lost = [i for i, ks in files if not {license_index.TEMPLATES[k][0] for k in ks} <= got[i]]
    assert not lost, len(lost)


def test_licences_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = [*license_index.VOCABULARY, "zz", "a"]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.integers(0, 6)):
            part = license_index.TEMPLATES[rng.integers(len(license_index.TEMPLATES))][1].split()
            for _ in range(rng.integers(0, 6)):  # changed words
                part[rng.integers(len(part))] = str(rng.choice(vocabulary))
            words += [*part, *rng.choice(vocabulary, rng.integers(0, 4))]
        rows.append((i, " ".join(words)))
    for r in license_index.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        words = rows[r["doc_id"]][1].split()
        want, best = set(filter(None, r["base_labels"].split(","))), 0.5 * bool(r["base_labels"])
        for label, text, phrase in license_index.TEMPLATES:
            t = text.split()
            keys = license_index._key_offsets(t, phrase.split())
            known = [k for k, w in enumerate(t) if w not in license_index.COMMON]
            for start in range(-len(t), len(words)):
                same = [k for k in known if 0 <= start + k < len(words) and words[start + k] == t[k]]
                if len(same) >= max(2, math.ceil(len(known) / 2)) and set(keys) & set(known) <= set(same):
                    want, best = want | {label}, max(best, len(same) / len(known))
        assert set(filter(None, r["labels"].split(","))) == want and r["score"] == pytest.approx(best)


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1_500, 16)) + 2 * rng.standard_normal((12, 16))[rng.integers(0, 12, 1_500)]
    x[100:400] = x[100]  # a large group of equal vectors
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(5_000, None, 0), (5_050, [0.0] * 16, 0), (5_100, [float("nan")] * 16, 0), (5_150, [1.0] * 15 + [None], 0), (None, x[0].tolist(), 0), (5_200, [1.0] * 3, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, list int").repartition(5)
    got = {}
    for r in sorted(posting_ann.nearest(df, df.where("vec_id % 50 = 0"), 5).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r)
    assert set(got) == set(range(0, 1_500, 50))
    hits = 0
    for q, found in got.items():
        s = posting_ann.cosine(x[q], x)
        order = [i for i in np.lexsort((np.arange(len(x)), -s)).tolist() if i != q][:5]
        assert [r["rank"] for r in found] == [1, 2, 3, 4, 5] and all(r["score"] == s[r["vec_id"]] for r in found)
        hits += len({r["vec_id"] for r in found} & set(order))
    assert hits >= 0.9 * 5 * len(got)
    assert [r["vec_id"] for r in got[200]] == [100, 101, 102, 103, 104]  # ties to the smaller identifier
    assert posting_ann.nearest(df.where("vec_id < 0"), df, 5).count() == 0
    assert posting_ann.nearest(df.where("vec_id < 3"), df.where("vec_id = 0"), 5).count() == 2


WORDS = ["house", "river", "green", "walked", "mother", "yellow", "garden", "stupid", "window", "letter", "idiot", "evening", "book"]


@pytest.fixture(scope="module")
def toxic(spark):
    rng = np.random.default_rng(6)
    plain = [w for w in WORDS if w not in ("stupid", "idiot")]
    rows = []
    for i in range(600):
        bad = i % 6 == 0
        words = list(rng.choice(plain, 40)) + (["stupid", "idiot"] if bad else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df, toxicity.fit(df.select("doc_id", "text"), toxicity.training_labels(df.select("doc_id", "toxic")))


@pytest.mark.parametrize("noisy", ["1d10t", "stuuupid", "i d i o t", "s.t.u.p.i.d", "$tupid", "idi0t", "STUPID"])
def test_noise_is_decoded(toxic, noisy):
    model = toxic[1]
    hits = toxicity.Scorer(model).hits(f"the mother walked to {noisy} in the green garden")
    assert set(hits) & {"stupid", "idiot"}, hits
    assert model.score(list(hits.values())) >= 0.5


@pytest.fixture(scope="module")
def chatty(spark):
    """A scorer from sentences with short words."""
    rng = np.random.default_rng(8)
    plain = ["you", "are", "an", "a", "i", "what", "idea", "this", "is", "so", "the", "that", "tool", "all", "love", "we", "to", "house", "river", "green", "garden"]
    rows = []
    for i in range(600):
        words = list(rng.choice(plain, 40)) + (["stupid", "idiot"] if i % 6 == 0 else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(i % 6 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return toxicity.fit(df.select("doc_id", "text"), toxicity.training_labels(df.select("doc_id", "toxic")))


@pytest.mark.parametrize("text", [
    "what a s t u p i d idea", "y o u a r e a n i d i o t", "t h i s i s s o s t u p i d", "i a m a n i d i o t", "what a s.t.u.p.1.d idea",
    "t h a t t o o l i s s t u u u u p i d", "y.o.u.a.r.e.s.t.u.p.i.d", "w e a l l l o v e t h e r i v e r y o u i d i 0 t",
])
def test_spaced_runs_are_several_words(chatty, text):
    hits = toxicity.Scorer(chatty).hits(text)
    assert set(hits) & {"stupid", "idiot"}, hits


def test_spaced_runs_in_words(chatty):
    words = lambda t: toxicity.decode(t, chatty.chars).split(" ")
    assert words("y o u a r e a n i d i o t") == ["you", "are", "an", "idiot"]
    assert words("t h a t t o o l") == ["that", "tool"]
    assert words("s t u u u u p i d") == ["stupid"]


@pytest.mark.parametrize("noisy", [
    "stu" + "u" * 50 + "pid", "s" + "-" * 60 + "tupid", "s--t--u--p--i--d", "1" + "d" * 100 + "1" + "0" * 100 + "t", ".".join("y0u" * 20) + "." + "s.t.u.p.i.d",
    "y o u a r e " * 5 + "s t u p i d", "s_._t" + "_" * 50 + "upid", "s t u " + "u " * 50 + "p i d",
])
def test_long_tokens_are_decoded(chatty, noisy):
    scorer = toxicity.Scorer(chatty)
    assert any("stupid" in w or "idiot" in w for w in scorer.restorer.words(f"what {noisy} idea")), scorer.restorer.words(noisy)
    if not noisy.startswith("y.0.u"):  # one long token without ends of words
        assert set(scorer.hits(f"what {noisy} idea")) & {"stupid", "idiot"}


def test_noisy_tokens_are_looked_at_once(chatty):
    text = "a1-b2_" * 20_000
    assert toxicity.Restorer(chatty.chars).tokens(text) == {"a", "b", "a1-b2_" * 19_999 + "a1-b2"}


def test_scores(toxic, odd, none):
    df, model = toxic
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    assert all((got[i]["score"] >= 0.5) == (i % 6 == 0) == bool(got[i]["predicted"]) for i in range(600))
    odd_scores = toxicity.score(odd, model).collect()
    assert len(odd_scores) == len(ODD) and all(0 <= r["score"] < 0.5 for r in odd_scores)
    kept = toxicity.drop_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() == len(ODD)
    assert toxicity.drop_toxic(df, model).count() == 500
    assert toxicity.score(none, model).count() == 0
    assert toxicity.score(odd, toxicity.fit(none, toxicity.training_labels(df))).count() == len(ODD)


def test_viterbi_is_the_best_path(toxic):
    chars = toxic[1].chars

    def paths(token, at=0):
        if at == len(token):
            yield "", 0.0
        for a, to, letters, cost in toxicity.lattice(token):
            if a == at:
                for rest, c in paths(token, to):
                    yield letters + rest, cost + c

    def score(text, cost):
        s = f"  {text} "
        return sum(float(chars.logp[tuple(chars.code(c) for c in s[i : i + 3])]) for i in range(len(s) - 2)) - cost

    for token in ("1d10t", "stuuupid", "gr33n", "b00k", "h0u5e"):
        assert toxicity.decode(token, chars) == max(paths(token), key=lambda p: (score(*p), p[0]))[0]


def test_held_out_rule(spark):
    labels = spark.createDataFrame([(i, 0) for i in range(50)], "doc_id long, toxic int")
    kept = {r["doc_id"] for r in toxicity.training_labels(labels).collect()}
    assert kept == {i for i in range(50) if zlib.crc32(str(i).encode()) % 5}
    assert labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).count() == 50 - len(kept)


def test_pipeline_equals_a_plain_version(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(11)
    plain = [w for w in WORDS if w not in ("stupid", "idiot")] + ["mountain", "silver", "ship", "table", "winter", "summer"]
    texts = []
    for i in range(240):
        words = list(rng.choice(plain, 60)) + (["stupid", "idiot"] if i % 6 == 0 else [])
        rng.shuffle(words)
        texts.append(" ".join(words) + (f" user{i}@mail.example.com" if i % 4 == 1 else ""))
    rows = list(enumerate(texts))
    rows += [(300, texts[1].upper()), (301, texts[2]), (302, texts[3] + " more"), (303, texts[5] + " and then")]  # equal and near copies
    rows += [(304, None), (305, ""), (306, ""), (None, "no id"), (None, None), (7, texts[7]), (7, texts[7])]  # nulls and repeated rows
    docs = [(i, t, f"s{k}", len(t or ""), bool(k % 2)) for k, (i, t) in enumerate(rows)]
    schema = "doc_id long, text string, key string, n_chars long, label boolean"  # names that operators use inside
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    made = []

    def kept(stage):
        def call(*args):
            made.append(stage(*args))
            made[-1] = made[-1].localCheckpoint()
            return made[-1]

        return call

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, kept(stage)) for name, stage in corpus_pipeline.STAGES])
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = [sorted(map(tuple, m.collect()), key=repr) for m in made[:4]]
    # Toxicity: the sixths with the words go, every column unchanged.
    want = [d for d in docs if not re.search("stupid|idiot", d[1] or "", re.I)]
    assert got[0] == sorted(want, key=repr)
    # Exact copies: of equal texts the largest identifier stays, in one row.
    by_text = {}
    for d in want:
        by_text.setdefault(norm(d[1]), []).append(d)
    best = {t: max((-1 if d[0] is None else d[0]) for d in ds) for t, ds in by_text.items()}
    assert sorted((norm(d[1]), -1 if d[0] is None else d[0]) for d in got[1]) == sorted(best.items())
    assert set(got[1]) <= set(want)
    # Near copies: of each component the smallest identifier stays; a null one is kept.
    named = brute_components([d[:2] for d in got[1]])
    assert got[2] == sorted((d for d, (i, _, c) in zip(got[1], named, strict=True) if i is None or i == c), key=repr)
    # Personal data: at least the patterns' spans are masked, other texts and columns stay.
    assert len(got[3]) == len(got[2])
    after = {d[2]: d for d in got[3]}
    for d in got[2]:
        new = after[d[2]]
        assert (d[0], d[4], d[1] is None) == (new[0], new[4], new[1] is None)
        assert (new[1] or "") == re.sub(r"user\d+@mail\.example\.com", "[EMAIL]", d[1] or "", flags=re.I)
        assert new[3] == len(new[1] or "")
    assert sum("[EMAIL]" in (d[1] or "") for d in got[3]) > 20
    # Packing: the pieces of every document hold all its tokens and an end, in sequences of at most 4096.
    length, end = {}, {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == end.get(r["sequence_id"], 0)
        end[r["sequence_id"]] = r["offset"] + r["length"]
        length[r["doc_id"]] = length.get(r["doc_id"], 0) + r["length"]
    assert max(end.values()) <= 4096
    assert length == {d[0]: len(encoded(WORD, d[1])) + 1 for d in got[3]}
    # An empty table passes every stage.
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    labels.write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
