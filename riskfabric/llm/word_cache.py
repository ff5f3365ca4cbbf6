"""Token ids of whole texts through the tokenizers library, one library call per distinct word.

A text is cut where the tokenizer's own pre-tokenizer cuts it; the library encodes each
distinct piece once, a table numbers the pieces, and the texts' ids are gathered by number. Cutting by a regular expression here is
only done for texts over ``_SAFE`` characters, for which the expression's classes agree with
the library's; every other text, and each that may hold a special token, goes to the library whole.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from itertools import chain, islice

import numpy as np
import pyarrow.fs as pafs

from riskfabric.llm.common import held_alone

_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
#: ASCII without the four separators U+001C-1F, Latin letters without U+0130 (lower case of two
#: characters), no numbers outside ASCII, common punctuation and currency signs.
_SAFE = re.compile("[\x00-\x1b -\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ſ‐-‧₠-₿]*")
_BYTE_LEVEL = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s{_LETTERS}0-9]+|\\s+(?!\\S)|\\s+"
)
_LOWER_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s{_LETTERS}0-9]+")
#: Words, and characters of words, kept a worker process; the table is emptied when it is full.
MOST_WORDS, MOST_CHARS = 600_000, 32 << 20
#: Words of letters that one call encodes in a row.
ROW = 200


class WordCache:
    """Numbers of words, and each one's ids (``dtype``) in one array."""

    def __init__(self, spec: bytes, lower: bool, specials: tuple[str, ...], dtype: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(spec)
        self.lower, self.dtype = lower, np.dtype(dtype)
        self.pattern = _LOWER_WORDS if lower else _BYTE_LEVEL
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        # Tokens that begin (a space and letters) or, by the end mark, end a word: words encoded in a row are told apart by them.
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.edge = np.array([t.endswith("</w>") if lower else t.startswith("Ġ") for t in names])
        self._clear()

    def _clear(self) -> None:
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__  # a new word gets the next number
        self.chars = 0
        self.ids, self.ends = np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def _learn(self, known: int) -> None:
        """Encode the words numbered from ``known`` on."""
        new = list(islice(reversed(self.number), len(self.number) - known))[::-1]
        plain = [w.isalpha() if self.lower else w[0] == " " and w[1:].isalpha() for w in new]
        row = [w for w, p in zip(new, plain, strict=True) if p]
        other = [e.ids for e in self.tokenizer.encode_batch_fast([w for w, p in zip(new, plain, strict=True) if not p], add_special_tokens=False)]
        # Words of letters are encoded many at a time; cutting them apart again is what the pre-tokenizer does.
        gap = " " if self.lower else ""
        rows = self.tokenizer.encode_batch_fast([gap.join(row[i : i + ROW]) for i in range(0, len(row), ROW)], add_special_tokens=False)
        flat = np.fromiter(chain.from_iterable(e.ids for e in rows), np.int64)
        edges = np.flatnonzero(self.edge[flat])
        row_ends = edges + 1 if self.lower else np.r_[edges[1:], len(flat)][: len(edges)]
        if len(row_ends) != len(row):
            raise ValueError("words encoded in a row can't be told apart")
        other_ends = np.cumsum([len(x) for x in other], dtype=np.int64) + len(flat)
        flat = np.r_[flat, np.fromiter(chain.from_iterable(other), np.int64)]
        # Back into the order of the words' numbers.
        first, last = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        is_row = np.array(plain, bool)
        for pick, ends, start in ((is_row, row_ends, 0), (~is_row, other_ends, len(flat) - sum(map(len, other)))):
            last[pick] = ends
            first[pick] = np.r_[start, ends[:-1]][: len(ends)]
        sizes = last - first
        stops = np.cumsum(sizes)
        self.ids = np.r_[self.ids, flat[np.repeat(first - stops + sizes, sizes) + np.arange(int(sizes.sum()))].astype(self.dtype)]
        self.ends = np.r_[self.ends, self.ends[-1] + stops]
        self.chars += sum(map(len, new))

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, self.dtype).tobytes() for e in found]

    def pieces(self, text: str) -> list[str] | None:
        """The pre-tokens of ``text``; None where only the library may cut it."""
        if _SAFE.fullmatch(text) is None or (self.special and self.special.search(text)):
            return None
        return self.pattern.findall(text.lower() if self.lower else text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        if len(self.number) > MOST_WORDS or self.chars > MOST_CHARS:
            self._clear()
        known = len(self.number)
        cut = [self.pieces(t) for t in texts]
        fast = [c for c in cut if c is not None]
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(fast)), np.int64, sum(map(len, fast)))
        if len(self.number) > known:
            self._learn(known)
        first = self.ends[at]
        sizes = self.ends[at + 1] - first
        stops = np.cumsum(sizes)
        data = self.ids[np.repeat(first - stops + sizes, sizes) + np.arange(int(sizes.sum()))].tobytes()
        # Where each text's ids end, in bytes.
        words = np.cumsum([len(c) for c in fast], dtype=np.int64)
        bounds = iter((np.r_[0, stops][words] * self.dtype.itemsize).tolist())
        rest = iter(self.whole([t for t, c in zip(texts, cut, strict=True) if c is None]))
        out, begin = [], 0
        for c in cut:
            if c is None:
                out.append(next(rest))
            else:
                end = next(bounds)
                out.append(data[begin:end])
                begin = end
        return out


def read_bytes(path: str) -> bytes:
    """A whole file of a tokenizer, at a path or URI that every worker can read."""
    if "://" in path:
        fs, at = pafs.FileSystem.from_uri(path)
        with fs.open_input_file(at) as f:
            return f.read()
    with open(path, "rb") as f:
        return f.read()


def word_cache(path: str, lower: bool = False, specials: tuple[str, ...] = (), dtype: str = "<u4") -> WordCache:
    """This worker process's cache for the tokenizer file at ``path`` (a path or URI every worker can read)."""
    return held_alone(f"words of {(path, lower, specials, dtype)}", None, lambda: WordCache(read_bytes(path), lower, specials, dtype))


BYTE_SPECIALS = ("<|endoftext|>",)
LOWER_SPECIALS = ("<|startoftext|>", "<|endoftext|>")
