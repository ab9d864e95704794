"""Token counts by overlap resynchronisation.

Texts up to ``chunk_chars`` are counted whole: with a memo of pre-token runs
where the file is byte-level BPE of the usual pattern, else in batches by the
library.  Longer ones are encoded as overlapping chunks and spliced where two
chunks agree:

* A chunk is right from its first *proven* boundary on.  A pre-token starts
  with no knowledge of what lies before it (the splitting pattern looks only
  ahead), so from a position that starts a pre-token in a right chunk, the
  rest of the encoding depends on the rest of the text alone.
* The next chunk starts ``overlap_chars`` before the end of the right one.
  The last position that starts a pre-token in both, and lies at least
  ``margin`` characters before the right chunk's end (so that neither the
  pattern's look-ahead nor a special string cut by the end can matter), is a
  boundary of the whole text's encoding as well; both are spliced there.
* If there is none, the overlap is doubled.  Once it would reach back to the
  right chunk's own start, the text is encoded anew from that proven start in
  a chunk twice as long.  One endless pre-token thus ends as one chunk, which
  is what the library itself does with it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ledgerline.llm.common import arrow_rows, slices
from ledgerline.llm.memo_encoder import memo_encoder, memo_fits

#: Texts handed to the library at once.
BATCH_ROWS = 256


class ChunkedEncoder:
    """Token ids of texts of any length, with bounded chunks.

    ``margin`` must cover the longest special string plus the look-ahead of
    the splitting pattern (two characters).
    """

    def __init__(self, tokenizer_path: str, chunk_chars: int = 1 << 16, overlap_chars: int = 512):
        from tokenizers import Tokenizer

        if not 0 < overlap_chars < chunk_chars:
            raise ValueError("overlap_chars must lie between 0 and chunk_chars")
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"] is not None:
            raise ValueError("splicing needs a tokenizer that does not rewrite the text")
        self.memo = memo_encoder(tokenizer_path) if memo_fits(spec) else None
        special = [t["content"] for t in spec["added_tokens"]]
        self.margin = 4 + max(map(len, special), default=0)
        self.chunk, self.overlap = max(chunk_chars, 4 * self.margin), max(overlap_chars, 2 * self.margin)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the library gives them without added special tokens."""
        out: list[np.ndarray | None] = [None] * len(texts)
        short = [i for i, t in enumerate(texts) if len(t) <= self.chunk]
        for at in range(0, len(short), BATCH_ROWS):
            part = short[at : at + BATCH_ROWS]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([texts[i] for i in part], add_special_tokens=False)):
                out[i] = np.array(e.ids, dtype=np.uint32)
        for i, t in enumerate(texts):
            if out[i] is None:
                out[i] = np.concatenate([*self.encode_long(t), np.empty(0, np.uint32)])
        return out

    def count_batch(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        short = [i for i, t in enumerate(texts) if len(t) <= self.chunk]
        if self.memo:
            for i in short:
                out[i] = len(self.memo.encode(texts[i])) // 4
            short = []
        for at in range(0, len(short), BATCH_ROWS):
            part = short[at : at + BATCH_ROWS]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([texts[i] for i in part], add_special_tokens=False)):
                out[i] = len(e)
        for i, t in enumerate(texts):
            if len(t) > self.chunk:
                out[i] = sum(map(len, self.encode_long(t)))
        return out

    def _encode(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of ``text[start:end]``; where its pre-tokens start: token index and position in ``text``."""
        e = self.tokenizer.encode(text[start:end], add_special_tokens=False)
        ids = np.array(e.ids, dtype=np.uint32)
        word = np.array([-1 if w is None else w for w in e.word_ids], dtype=np.int64)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(ids) else np.empty(0, np.int64)
        offsets = e.offsets
        return ids, first, start + np.array([offsets[i][0] for i in first], dtype=np.int64)

    def encode_long(self, text: str) -> Iterator[np.ndarray]:
        """Ids of ``text`` piece by piece."""
        n, start, chunk = len(text), 0, self.chunk
        ids, first, at = self._encode(text, 0, min(n, chunk))
        end, skip = min(n, chunk), 0  # ids[skip:] start at the proven boundary `start`
        while end < n:
            overlap, spliced = self.overlap, False
            trusted = at[at <= end - self.margin]
            while not spliced and end - overlap > start:
                begin = end - overlap
                until = min(n, begin + chunk)
                if until <= end:
                    break
                ids2, first2, at2 = self._encode(text, begin, until)
                both = np.intersect1d(trusted[trusted > start], at2)
                if len(both):
                    p = both[-1]
                    yield ids[skip : first[np.searchsorted(at, p)]]
                    ids, first, at, skip = ids2, first2, at2, first2[np.searchsorted(at2, p)]
                    start, end, spliced = int(p), until, True
                    chunk = self.chunk
                overlap *= 2
            if not spliced:  # widen from the boundary that is proven
                chunk = 2 * max(chunk, end - start)
                end = min(n, start + chunk)
                ids, first, at = self._encode(text, start, end)
                skip = 0
        yield ids[skip:]


@lru_cache(maxsize=4)
def encoder(tokenizer_path: str, chunk_chars: int, overlap_chars: int) -> ChunkedEncoder:
    """One encoder per Python worker and setting."""
    return ChunkedEncoder(tokenizer_path, chunk_chars, overlap_chars)


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    chunk_chars: int = 1 << 16,
    overlap_chars: int = 512,
) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every whole text.

    Narrow: no shuffle, one pass, memory bounded by a record batch and a
    chunk.  Null and empty texts have 0 bytes and 0 tokens; null and repeated
    ids are kept as they are, a row for each input row; an empty table gives
    an empty result; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, chunk_chars, overlap_chars)
        for part in slices(batch, BATCH_ROWS):
            text = pc.fill_null(part.column(1), "")
            n = enc.count_batch(text.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pc.cast(pc.binary_length(text), pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"`{id_col}` {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return arrow_rows(docs.select(id_col, text_col), count, schema)
