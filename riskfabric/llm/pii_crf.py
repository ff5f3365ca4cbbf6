"""Personal data by patterns and a character-level bidirectional LSTM with a CRF.

``base_spans`` finds the four kinds by their patterns, leftmost and without overlaps per kind.
``Tagger`` is a bidirectional LSTM over character classes whose outputs score the tags of a linear-chain
CRF; it is trained in numpy from labelled spans (the pattern spans of a bounded sample and the
same spans written in noisy ways, which no pattern finds). Tags: 0 for other text, then for each kind
one tag for a span's first character and one for the rest.

A text is cut into overlapping windows. Every window is decoded by the Viterbi algorithm; a character's
tags come from the window in which it lies deepest, and spans that meet at a seam with the same kind
are one span. Spans of the method are added where they overlap no pattern span; a pattern span is never
changed or dropped. The numbers' spans hold digits, an e-mail address '@' or "at" as a word; every window with a
digit, '@' or one of the words "at" and "dot" is decoded.

Defined results: null and empty texts have no spans; repeated rows are tagged each; an empty
table gives no rows; a sample without any span gives a tagger that adds none.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfabric.llm.common import hash_sample, map_arrow, scratch_table, slices, texts_of

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)
#: Training sample: documents at most (those with the smallest hash of their identifier, among those with a pattern span).
SAMPLE_DOCS, SNIPPETS, EPOCHS, HIDDEN = 4_000, 4_000, 6, 16
WINDOW, STRIDE = 96, 48
SEED = 7

_AFTER_AT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, kinds in order, each by start."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _AFTER_AT.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or "0") <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((3, *m.span()))
    return out


def _classes() -> np.ndarray:
    """Character classes: each printable ASCII character its own, digits and letters by kind, the rest by a few."""
    table = np.full(0x110000, 1, np.int16)
    table[0x80:] = 2
    table[[0x09, 0x0A, 0x0D]] = 3
    n = 4
    for c in range(0x20, 0x7F):
        if chr(c).isdigit():
            table[c] = 4
        elif chr(c).isupper():
            table[c] = 5
        elif chr(c).islower():
            table[c] = 6
    n = 7
    for c in range(0x20, 0x7F):
        if not chr(c).isalnum():
            table[c], n = n, n + 1
    for c in "ademotx":  # letters of "at", "dot", "com", "ext"
        table[ord(c)], n = n, n + 1
    return table


_CLASS = _classes()
CLASSES = int(_CLASS.max()) + 1


def codes(text: str) -> np.ndarray:
    return _CLASS[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Tagger:
    """Weights: per direction an input table (classes x 4h) and a recurrent matrix (h x 4h); then the CRF."""

    inputs: list[np.ndarray] = field(default_factory=list)
    recur: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(TAGS, np.float32))
    trans: np.ndarray = field(default_factory=lambda: np.zeros((TAGS, TAGS), np.float32))

    @classmethod
    def start(cls, rng: np.random.Generator, hidden: int = HIDDEN) -> Tagger:
        f = lambda *s: (rng.standard_normal(s) * 0.2).astype(np.float32)
        t = cls([f(CLASSES, 4 * hidden) for _ in "fb"], [f(hidden, 4 * hidden) for _ in "fb"], f(2 * hidden, TAGS))
        for x in t.inputs:
            x[:, hidden : 2 * hidden] += 1  # the forget gates start open
        return t

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recur, self.out, self.bias, self.trans]

    def run(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Tag scores (batch, time, tags) of class codes (batch, time)."""
        n, steps = x.shape
        hidden = self.recur[0].shape[0]
        both = np.empty((n, steps, 2 * hidden), np.float32)
        for d in (0, 1):
            h, c = np.zeros((n, hidden), np.float32), np.zeros((n, hidden), np.float32)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                z = self.inputs[d][x[:, t]] + h @ self.recur[d]
                s = _sigmoid(z[:, : 3 * hidden])
                g = np.tanh(z[:, 3 * hidden :])
                i, f, o = s[:, :hidden], s[:, hidden : 2 * hidden], s[:, 2 * hidden :]
                new = f * c + i * g
                tc = np.tanh(new)
                if keep is not None:
                    keep.append((d, t, h, c, i, f, o, g, tc))
                h, c = o * tc, new
                both[:, t, d * hidden : (d + 1) * hidden] = h
        if keep is not None:
            keep.append(both)
        return both @ self.out + self.bias

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log-likelihood of the tags ``y`` and its gradients, in the order of ``parameters``."""
        keep: list = []
        scores = self.run(x, keep)
        both = keep.pop()
        n, steps = x.shape
        hidden = self.recur[0].shape[0]
        # Forward and backward sums of the CRF.
        alpha, beta = np.zeros((steps, n, TAGS)), np.zeros((steps, n, TAGS))
        alpha[0] = scores[:, 0]
        for t in range(1, steps):
            v = alpha[t - 1][:, :, None] + self.trans
            m = v.max(axis=1)
            alpha[t] = m + np.log(np.exp(v - m[:, None]).sum(axis=1)) + scores[:, t]
        for t in range(steps - 2, -1, -1):
            v = self.trans + (scores[:, t + 1] + beta[t + 1])[:, None, :]
            m = v.max(axis=2)
            beta[t] = m + np.log(np.exp(v - m[:, :, None]).sum(axis=2))
        m = alpha[-1].max(axis=1)
        logz = m + np.log(np.exp(alpha[-1] - m[:, None]).sum(axis=1))
        rows = np.arange(n)
        gold = scores[rows[:, None], np.arange(steps), y].sum(axis=1) + self.trans[y[:, :-1], y[:, 1:]].sum(axis=1)
        d_scores = np.exp(alpha + beta - logz[None, :, None]).transpose(1, 0, 2)
        d_scores[rows[:, None], np.arange(steps), y] -= 1
        d_trans = np.zeros((TAGS, TAGS))
        for t in range(1, steps):
            d_trans += np.exp(alpha[t - 1][:, :, None] + self.trans + (scores[:, t] + beta[t])[:, None, :] - logz[:, None, None]).sum(axis=0)
        np.add.at(d_trans, (y[:, :-1], y[:, 1:]), -1)
        d_scores = (d_scores / n).astype(np.float32)
        flat = d_scores.reshape(-1, TAGS)
        d_out, d_bias = both.reshape(-1, 2 * hidden).T @ flat, flat.sum(axis=0)
        d_both = d_scores @ self.out.T
        d_in = [np.zeros_like(w) for w in self.inputs]
        d_rec = [np.zeros_like(w) for w in self.recur]
        carry = {0: (0.0, 0.0), 1: (0.0, 0.0)}
        for d, t, h, c, i, f, o, g, tc in reversed(keep):
            dh, dc = carry[d]
            dh = dh + d_both[:, t, d * hidden : (d + 1) * hidden]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1).astype(np.float32)
            np.add.at(d_in[d], x[:, t], dz)
            d_rec[d] += h.T @ dz
            carry[d] = dz @ self.recur[d].T, dc * f
        return float((logz - gold).mean()), [*d_in, *d_rec, d_out, d_bias, (d_trans / n).astype(np.float32)]

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tags of each row, by the Viterbi algorithm."""
        scores = self.run(x)
        n, steps, _ = scores.shape
        best, back = scores[:, 0], np.empty((steps, n, TAGS), np.int8)
        for t in range(1, steps):
            v = best[:, :, None] + self.trans
            back[t] = v.argmax(axis=1)
            best = v.max(axis=1) + scores[:, t]
        tags = np.empty((n, steps), np.int8)
        tags[:, -1] = best.argmax(axis=1)
        rows = np.arange(n)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t][rows, tags[:, t]]
        return tags


def train(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, hidden: int = HIDDEN, batch: int = 64, rate: float = 0.01) -> Tagger:
    """Adam over shuffled batches of windows (rows, time) and their tags."""
    rng = np.random.default_rng(SEED)
    t = Tagger.start(rng, hidden)
    # A span's inner tag never follows another kind or other text.
    for k in range(len(KINDS)):
        for j in range(TAGS):
            if j not in (1 + 2 * k, 2 + 2 * k):
                t.trans[j, 2 + 2 * k] = -20
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in t.parameters()]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            _, grads = t.gradients(x[part], y[part])
            norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
            step += 1
            for p, g, (a, b) in zip(t.parameters(), grads, moments, strict=True):
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return t


def tag_row(spans: list[tuple[int, int, int]], length: int) -> np.ndarray:
    y = np.zeros(length, np.int8)
    for kind, start, end in spans:
        y[start:end] = 2 + 2 * kind
        y[start] = 1 + 2 * kind
    return y


def noisy(kind: int, value: str, rng: np.random.Generator) -> str:
    """The same data as people write it to escape patterns."""
    if kind == 0:
        name, _, host = value.partition("@")
        at = (" @ ", "@ ", " @", " (at) ", " [at] ", " at ", "(at)", "[at]")[rng.integers(8)]
        dot = (".", " . ", " dot ", "(dot)", ". ", " (dot) ", " [dot] ", "[dot]")[rng.integers(8)]
        return name + at + host.replace(".", dot)
    if kind == 1:
        return value.replace(".", (" . ", ". ", "[.]", " .")[rng.integers(4)])
    if kind == 2:
        digits, gap = _digits(value), ("  ", ".", " - ", "_", "/")[rng.integers(5)]
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    digits = _digits(value)
    form = ("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "tel: {} {} {}")[rng.integers(4)]
    return form.format(digits[-10:-7] or "555", digits[-7:-4] or "555", digits[-4:])


def training_windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows around the pattern spans of the texts, as they are and rewritten, and windows without spans."""
    rng = np.random.default_rng(SEED)
    xs, ys = [], []

    def add(text: str, spans: list[tuple[int, int, int]], at: int) -> None:
        start = max(0, at - int(rng.integers(8, WINDOW - 8)))
        part = text[start : start + WINDOW]
        y = np.zeros(WINDOW, np.int8)
        y[: len(part)] = tag_row([(k, max(a - start, 0), b - start) for k, a, b in spans if b > start and a < start + WINDOW], WINDOW)[: len(part)]
        x = np.zeros(WINDOW, np.int16)
        x[: len(part)] = codes(part)
        xs.append(x)
        ys.append(y)

    for text in texts:
        # Where kinds overlap the earlier one in their order labels the characters.
        spans, taken = [], np.zeros(len(text) + 1, bool)
        for s in base_spans(text):
            if not taken[s[1] : s[2]].any():
                taken[s[1] : s[2]] = True
                spans.append(s)
        for kind, a, b in spans[:4]:
            add(text, spans, a)
            left, value, right = text[max(0, a - WINDOW) : a], noisy(kind, text[a:b], rng), text[b : b + WINDOW]
            add(left + value + right, [(kind, len(left), len(left) + len(value))], len(left))
        for asks in (_SIGN, _AT_DOT):
            for m in itertools.islice(asks.finditer(text), 40):
                if not taken[max(0, m.start() - 1) : m.end() + 1].any():
                    add(text, spans, m.start())
                    break
        if len(text) > WINDOW:
            add(text, spans, int(rng.integers(0, len(text))))
        if len(xs) >= 5 * SNIPPETS:
            break
    if not xs:
        return np.zeros((0, WINDOW), np.int16), np.zeros((0, WINDOW), np.int8)
    pick = rng.permutation(len(xs))[:SNIPPETS]
    return np.array(xs)[pick], np.array(ys)[pick]


def sample_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, t: of every text with a pattern span a piece around one of its spans, chosen by the identifier's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, pieces = [], []
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if spans := base_spans(text):
                    start = max(0, spans[zlib.crc32(str(i).encode()) % len(spans)][1] - 300)
                    ids.append(i)
                    pieces.append(text[start : start + 900])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(pieces, pa.string())], names=["doc_id", "t"])

    texts = texts_of(docs, id_col, text_col).where(F.col("text").rlike("[0-9@]"))  # every pattern needs one
    return map_arrow(texts, run, "doc_id long, t string")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Tagger | None:
    """Train on a bounded sample of the documents with a pattern span (None if there is none)."""
    # Only pieces are written, sorted and collected: the sample's size has a bound, whatever the texts' length.
    pieces = scratch_table(sample_pieces(docs, id_col, text_col), "pii_pieces")
    rows = hash_sample(pieces, "doc_id", SAMPLE_DOCS, "t").select("t").collect()
    x, y = training_windows([r["t"] for r in rows])
    return train(x, y) if (y > 0).any() else None


def _seams(tags: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Spans of one reconciled row of tags."""
    out: list[list[int]] = []
    kinds = (tags.astype(np.int64) + 1) // 2 - 1  # -1: other text
    hits = np.flatnonzero(kinds >= 0)
    for i in hits.tolist():
        k = int(kinds[i])
        first = tags[i] == 1 + 2 * k
        if out and out[-1][2] == i and out[-1][0] == k and not first:
            out[-1][2] = i + 1
        else:
            out.append([k, i, i + 1])
    return [tuple(s) for s in out if s[2] <= length]


def method_spans(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, int]]]:
    """Spans of the tagger for each text: windows of all texts are decoded together and reconciled by text."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    windows, places = [], []
    flats = {}
    for k, text in enumerate(texts):
        words = [p for m in _AT_DOT.finditer(text) for p in (m.start(), m.end() - 1)]
        if not words and "@" not in text and not _HAS_DIGIT.search(text):
            continue
        flat = codes(text)
        asks = np.concatenate([np.flatnonzero((flat == _CLASS[ord("0")]) | (flat == _CLASS[ord("@")])), np.array(words, np.int64)])
        # Every window in which such a character or word lies.
        last = max(0, -(-(len(flat) - WINDOW) // STRIDE))
        near = np.unique(np.clip(np.concatenate([asks // STRIDE - j for j in range(WINDOW // STRIDE)]), 0, last))
        flats[k] = flat
        for w in near.tolist():
            part = flat[w * STRIDE : w * STRIDE + WINDOW]
            x = np.zeros(WINDOW, np.int16)
            x[: len(part)] = part
            windows.append(x)
            places.append((k, w))
    tags = {k: np.zeros(len(f), np.int8) for k, f in flats.items()}
    depth = {k: np.full(len(f), -1, np.int16) for k, f in flats.items()}
    own = np.minimum(np.arange(WINDOW), WINDOW - 1 - np.arange(WINDOW)).astype(np.int16)
    for at in range(0, len(windows), 1024):
        decoded = tagger.decode(np.array(windows[at : at + 1024]))
        for (k, w), row in zip(places[at : at + 1024], decoded, strict=True):
            a, b = w * STRIDE, min(w * STRIDE + WINDOW, len(flats[k]))
            d = own[: b - a].copy()
            if w == 0:
                d = np.maximum(d, WINDOW - 1 - np.arange(b - a, dtype=np.int16))  # nothing lies before
            if b == len(flats[k]):
                d = np.maximum(d, np.arange(b - a, dtype=np.int16))
            deeper = d > depth[k][a:b]
            tags[k][a:b][deeper] = row[: b - a][deeper]
            depth[k][a:b][deeper] = d[deeper]
    for k, t in tags.items():
        text = texts[k]
        for kind, a, b in _seams(t, len(text)):
            part = text[a:b]
            # Spaces and line ends at its edges belong to no span.
            a, b = a + len(part) - len(part.lstrip()), b - (len(part) - len(part.rstrip()))
            if b > a and _CONTENT[kind].fullmatch(text[a:b]):
                found[k].append((kind, a, b))
    return found


_HAS_DIGIT = re.compile(r"[0-9]")
_SIGN = re.compile(r"[0-9@]")
#: "at" and "dot" as words, also in brackets.
_AT_DOT = re.compile(r"(?<![^\W_])(?:[aA][tT]|[dD][oO][tT])(?![^\W_])")
_SIGNS = r"[^\n0-9]{0,5}"
#: What a span of the method must hold, by kind: a sign or word for "at" between other characters, and after the word
#: a sign or word for "dot" unless there is a digit or '@' (no address is without a dot); four numbers;
#: 13 to 19 digits; 7 to 15 digits. No line ends, at most five other characters between two digits.
_CONTENT = (
    re.compile(r"(?=.*[0-9@]|.*\b(?i:at)\b.*(?:\.|\b(?i:dot)\b))[^\n]*[^\s][^\n]{0,3}(?:@|\b(?i:at)\b)[^\n]{0,3}[^\s][^\n]*"),
    re.compile(rf"(?:[0-9]{{1,3}}{_SIGNS}){{3}}[0-9]{{1,3}}"),
    re.compile(rf"(?:[0-9]{_SIGNS}){{12,18}}[0-9]"),
    re.compile(rf"[^\n0-9]{{0,6}}(?:[0-9]{_SIGNS}){{6,14}}[0-9]"),
)


def all_spans(texts: list[str], tagger: Tagger | None) -> tuple[list, list]:
    """Base spans and all spans (kinds in order, then by start) of each text."""
    base = [base_spans(t) for t in texts]
    more = method_spans(texts, tagger) if tagger else [[]] * len(texts)
    both = []
    for own, extra in zip(base, more, strict=True):
        free = [s for s in extra if not any(a < s[2] and s[1] < b for _, a, b in own)]
        both.append(sorted(own + free))
    return base, both


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (patterns and method), base_sha256, spans, n_added."""
    held = docs.sparkSession.sparkContext.broadcast(tagger)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base, both = all_spans(batch.column("text").to_pylist(), held.value)
            counts = [pa.array([sum(s[0] == k for s in spans) for spans in both], pa.int64()) for k in range(len(KINDS))]
            shas = [hashlib.sha256(written(spans).encode()).hexdigest() for spans in base]
            added = pa.array([len(b) - len(a) for a, b in zip(base, both, strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array(shas, pa.string()), pa.array([written(s) for s in both], pa.string()), added], names=names)

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return map_arrow(texts_of(docs, id_col, text_col), run, schema)


def mask(docs: DataFrame, tagger: Tagger | None, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans are masked as one,
    under the first one's kind. ``length_col``, if given, is set to the new text's length in characters.
    Null texts stay null."""
    held = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).to_pylist()
            _, both = all_spans([t or "" for t in texts], held.value)
            new = [t if t is None else masked(t, s) for t, s in zip(texts, both, strict=True)]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if length_col:
                k = batch.schema.get_field_index(length_col)
                old = columns[k].to_pylist()
                columns[k] = pa.array([o if n == t else len(n) for o, n, t in zip(old, new, texts, strict=True)], batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_arrow(docs, run, docs.schema)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])
