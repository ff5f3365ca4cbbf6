"""Token counts by the whole-token shortcut.

``whole_tokens`` proves once, by encoding every string of the vocabulary alone, which of
them are a single token. A pre-token found among them counts one without any merging; only
the remaining distinct pre-tokens of a slice are merged by the library.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows are counted
each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfabric.llm.common import map_arrow, slices, texts_of
from riskfabric.llm.word_cache import BYTE_SPECIALS, word_cache


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that the tokenizer encodes, alone, as exactly their own id.

    A byte-level vocabulary entry that is no valid UTF-8 on its own never equals a
    pre-token and is left out. The result is bounded by the vocabulary.
    """
    tokenizer = word_cache(path, False, BYTE_SPECIALS).tokenizer
    size = tokenizer.get_vocab_size(with_added_tokens=False)
    strings = [tokenizer.decode([i], skip_special_tokens=False) for i in range(size)]
    alone = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    return frozenset(s for i, (s, e) in enumerate(zip(strings, alone, strict=True)) if list(e.ids) == [i])


#: Merged pre-tokens kept a worker process, and the longest one that is kept.
MOST_WORDS, LONG_WORD = 250_000, 64
_KNOWN: dict[str, dict[str, int]] = {}


def _known(path: str, proven) -> dict[str, int]:
    """pre-token -> tokens in this worker: the proven strings, then what was merged before."""
    if path not in _KNOWN:
        _KNOWN[path] = dict.fromkeys(proven.value, 1)
    return _KNOWN[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) and n_shortcut, the pre-tokens counted without merging."""
    proven = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(path, False, BYTE_SPECIALS)
        known, sure = _known(path, proven), proven.value
        for batch in slices(batches):
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            cut = [cache.pieces(t) for t in texts]
            if len(known) > len(sure) + MOST_WORDS:
                known.clear()
                known.update(dict.fromkeys(sure, 1))
            new = list(set().union(*(c for c in cut if c is not None)).difference(known))
            merged = cache.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            known.update((w, len(e.ids)) for w, e in zip(new, merged, strict=True))
            get, has, n_tokens, short = known.__getitem__, sure.__contains__, [], []
            for text, c in zip(texts, cut, strict=True):
                if c is None:
                    n_tokens.append(len(cache.tokenizer.encode(text, add_special_tokens=False).ids))
                    short.append(0)
                else:
                    n_tokens.append(sum(map(get, c)))
                    short.append(sum(map(has, c)))
            for w in new:
                if len(w) > LONG_WORD:
                    del known[w]
            yield pa.RecordBatch.from_arrays(
                [ids, pc.cast(pc.binary_length(batch.column("text")), pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(short, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "n_shortcut"],
            )

    out = map_arrow(texts_of(docs, id_col, text_col), run, "doc_id long, n_bytes long, n_tokens long, n_shortcut long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_shortcut")
