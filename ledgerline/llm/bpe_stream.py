"""BPE encoding and decoding as streaming transducers.

Encoding.  A pre-token is fed symbol by symbol; ids leave as soon as no
further symbol can change them.  How far ahead that needs to look follows
from the merge list alone.  A merge ``(u, v)`` can only be kept from
happening, from the right, by an earlier merge ``(x, y)`` that takes away a
suffix constituent ``x`` of ``v``; that one again only by a still earlier
merge that takes away a suffix constituent of ``y``, and so on.  Ranks fall
along such a chain, so one pass over the merges in rank order gives the
longest chain in symbols: the *sufficient lookahead*.  A token that ends that
many symbols before the end of the buffer is stable.  The buffer holds a
block and the lookahead, however long the pre-token is.

This needs a proper merge list (both parts of a merge are symbols or made by
earlier merges), which is checked; encoding then also splits at any token
boundary, so the buffer can start at the last emitted token.

Decoding.  Ids become bytes, and bytes become text through an incremental
UTF-8 decoder that keeps at most the bytes of one unfinished character.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerline.llm.common import arrow_rows, slices

#: White space of the normalizer's pattern (fixed values: Unicode White_Space).
WHITE = "\t-\r \x85\xa0  -     　"
#: Characters handled at once, and symbols of a long pre-token between emissions.
SLICE_CHARS, BLOCK = 1 << 16, 512
#: Pre-tokens whose ids a worker remembers.
MEMO_WORDS = 1 << 18
#: Whether array() writes ids as they are digested.
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class MergeList:
    """Vocabulary and merges, with the lookahead they need."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], end: str):
        self.end = end
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.last = [vocab[c + end] for c in alphabet]
        self.text = {i: t for t, i in vocab.items()}
        made = {*self.inner, *self.last}
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        right: dict[int, int] = {}  # the part that a token ends with
        length = dict.fromkeys(made, 1)
        taken: dict[int, int] = {}  # for a token: the longest chain of merges so far that takes it away rightwards
        self.lookahead, self.proper = 1, True
        for rank, (a, b) in enumerate(merges):
            u, v, uv = vocab[a], vocab[b], vocab[a + b]
            self.proper &= u in made and v in made and uv not in made
            chain, x = 0, v
            while x is not None:
                chain = max(chain, taken.get(x, 0))
                x = right.get(x)
            depth = length.get(v, 1) + chain
            taken[u] = max(taken.get(u, 0), depth)
            self.lookahead = max(self.lookahead, depth)
            self.rules.setdefault((u, v), (rank, uv))
            made.add(uv)
            right.setdefault(uv, v)
            length.setdefault(uv, length.get(u, 1) + length.get(v, 1))
        self.length = length

    def merge(self, ids: list[int]) -> list[int]:
        """All merges of one symbol sequence, lowest rank first, then leftmost."""
        return self._merge_short([*ids]) if len(ids) <= 24 else self._merge_heap([*ids])

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, none = self.rules.get, (len(self.rules), -1)
        pairs = [get(p, none) for p in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best is none:
                break
            i = pairs.index(best)
            ids[i : i + 2] = [best[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(pairs):
                pairs[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_heap(self, ids: list[int]) -> list[int]:
        rules, n = self.rules, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rules.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two was merged meanwhile
            made = ids[i] = rules[a, b][1]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if r := rules.get((made, ids[k])):
                    heapq.heappush(heap, (r[0], i, made, ids[k]))
            h = before[i]
            if h >= 0 and (r := rules.get((ids[h], made))):
                heapq.heappush(heap, (r[0], h, ids[h], made))
        return [x for x in ids if x >= 0]


class WordTransducer:
    """Ids of one pre-token, fed in parts: memory is a block and the lookahead."""

    def __init__(self, merges: MergeList, block: int = BLOCK):
        self.m, self.block, self.buffer, self.held = merges, block, [], None

    def feed(self, data: bytes) -> Iterator[int]:
        for b in data:
            if self.held is not None:
                self.buffer.append(self.m.inner[self.held])
            self.held = b  # the last byte has a symbol of its own, so it waits
            if len(self.buffer) >= self.block + self.m.lookahead and self.m.proper:
                yield from self._emit()

    def _emit(self) -> Iterator[int]:
        stable, at = len(self.buffer) - self.m.lookahead, 0
        for t in self.m.merge(self.buffer):
            if at + self.m.length[t] > stable:
                break
            at += self.m.length[t]
            yield t
        del self.buffer[:at]

    def finish(self) -> Iterator[int]:
        if self.held is not None:
            yield from self.m.merge([*self.buffer, self.m.last[self.held]])
        self.buffer, self.held = [], None


class StreamCodec:
    """Encoder and decoder of a word-level BPE file (end-of-word marks, text lower-cased, white space dropped)."""

    def __init__(self, tokenizer_path: str, slice_chars: int = SLICE_CHARS, memo_words: int = MEMO_WORDS):
        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
            raise ValueError("a normalizer of NFC, Replace and Lowercase, and no decoder, are expected")
        self.merges = MergeList(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern.replace(r"\s", WHITE)).findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.token_text = self.merges.text | {i: t for t, i in self.special.items()}
        self.token_bytes = {i: t.encode() for i, t in self.token_text.items()}
        self.slice_chars, self.memo_words = slice_chars, memo_words
        self.words, self.chunks = _Memo(self._word), _Memo(self._chunk)
        self.gap = re.compile(f"[{WHITE}]")
        self._other_unicode(tokenizer_path, pattern)

    def _other_unicode(self, tokenizer_path: str, pattern: str) -> None:
        """Characters on which this Python and the library follow different versions of Unicode; the library's own normalizer and splitter take text that holds them."""
        from tokenizers import Regex, Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.own_normalizer = Tokenizer.from_file(tokenizer_path).normalizer
        self.own_split = Split(Regex(pattern), "removed", invert=True)
        every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        differ = {c for c in every if unicodedata.category(c) == "Cn"}
        known = "".join(c for c in every if c not in differ and unicodedata.category(c) != "Co")
        for kind in ("L", "N"):
            ours = {*regex.findall(rf"\p{{{kind}}}", known)}
            theirs = {t for t, _ in Split(Regex(rf"\p{{{kind}}}"), "removed", invert=True).pre_tokenize_str(known)}
            differ |= ours ^ theirs
        self.differs = frozenset(differ)
        self.control = re.compile("[\x1c-\x1f]")

    def word_ids(self, word: str) -> list[int]:
        data = word.encode()
        if len(data) <= BLOCK:
            symbols = list(map(self.merges.inner.__getitem__, data))
            symbols[-1] = self.merges.last[data[-1]]
            return self.merges.merge(symbols)
        t = WordTransducer(self.merges)
        return [i for at in range(0, len(data), BLOCK) for i in t.feed(data[at : at + BLOCK])] + list(t.finish())

    def _slices(self, text: str) -> Iterator[str]:
        """The text cut at white space, which no pre-token holds and nothing composes across."""
        at = 0
        while len(text) - at > self.slice_chars:
            gap = self.gap.search(text, at + self.slice_chars)
            # a white space with a combining mark behind it is no place to cut
            while gap and gap.end() < len(text) and not text[gap.end()].isascii() and unicodedata.combining(text[gap.end()]):
                gap = self.gap.search(text, gap.end())
            if gap is None:
                break
            yield text[at : gap.end()]
            at = gap.end()
        if at < len(text):
            yield text[at:] if at else text

    def _chunks(self, text: str) -> Iterator[list[str]]:
        """Normalized runs without white space, slice by slice."""
        for piece in self._slices(text):
            if not piece.isascii():
                if not self.differs.isdisjoint(piece):
                    piece = self.own_normalizer.normalize_str(piece)
                else:
                    piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")  # a sigma is lower-cased without context
            piece = piece.lower()
            # str.split() also cuts at four control characters that are no white space here
            yield piece.split() if not self.control.search(piece) else [x for x in self.gap.split(piece) if x]

    def _chunk(self, chunk: str) -> tuple[bytes, bytes]:
        words = self.words
        if not chunk.isascii() and not self.differs.isdisjoint(chunk):
            found = [t for t, _ in self.own_split.pre_tokenize_str(chunk)]
        elif chunk.isalpha():  # what the pattern gives, without it
            return words[chunk]
        elif chunk[-1] in ".,!?" and chunk[:-1].isalpha():
            found = (chunk[:-1], chunk[-1])
        else:
            found = self.split(chunk)
        ids, tokens = zip(*map(words.__getitem__, found))
        return b"".join(ids), b" ".join(tokens)

    def _word(self, word: str) -> tuple[bytes, bytes]:
        ids = self.word_ids(word)
        return array("I", ids).tobytes() if LITTLE else np.array(ids, dtype="<u4").tobytes(), b" ".join(map(self.token_bytes.__getitem__, ids))

    def encode(self, text: str) -> Iterator[tuple[bytes, bytes]]:
        """Pairs of ids (little-endian 32-bit) and the decoded tokens joined by spaces."""
        parts = self.special_split.split(text) if self.special and any(s in text for s in self.special) else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield self.special[part].to_bytes(4, "little"), part.encode()
                continue
            for chunks in self._chunks(part):
                for memo in (self.words, self.chunks):
                    if len(memo) > self.memo_words:
                        memo.clear()
                if chunks:
                    ids, tokens = zip(*map(self.chunks.__getitem__, chunks))
                    yield b"".join(ids), b" ".join(tokens)

    def encode_ids(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(ids for ids, _ in self.encode(text)), dtype="<u4")

    def decode_tokens(self, ids: Iterable[int]) -> str:
        """What a library without decoder gives: token strings with spaces between."""
        return " ".join(self.token_text[int(i)] for i in ids)

    def decode_text(self, ids: Iterable[int]) -> Iterator[str]:
        """Text, character by character as bytes complete it; an end of word is a space, bad bytes are U+FFFD."""
        back = {c: b for b, c in enumerate(byte_alphabet())}
        state, end = codecs.getincrementaldecoder("utf-8")("replace"), self.merges.end
        names = {i: s for s, i in self.special.items()}
        for i in ids:
            t = names.get(int(i))
            if t is None:
                t = self.token_text[int(i)]
                word_end = t.endswith(end)
                data = bytes(back[c] for c in (t[: -len(end)] if word_end else t)) + b" " * word_end
            else:
                data = t.encode()
            if out := state.decode(data):
                yield out
        if out := state.decode(b"", True):
            yield out


class _Memo(dict):
    """Results of ``make`` by string; those of long strings are not kept."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> tuple[bytes, bytes]:
        found = self.make(key)
        if len(key) <= 64:
            self[key] = found
        return found


@lru_cache(maxsize=2)
def codec(tokenizer_path: str) -> StreamCodec:
    """One codec per Python worker and file."""
    return StreamCodec(tokenizer_path)


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of every whole text.

    Ids and decoded text go into the digests piece by piece.  Null and empty
    texts have no ids and decode to the empty text; null and repeated ids are
    kept, a row for each input row; an empty table gives an empty result;
    other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer_path)
        for part in slices(batch, 256):
            n, ids_hex, text_hex = [], [], []
            for text in part.column(1).to_pylist():
                ids_sha, text_sha, count = hashlib.sha256(), hashlib.sha256(), 0
                for ids, tokens in c.encode(text or ""):
                    if count:
                        text_sha.update(b" ")
                    ids_sha.update(ids)
                    text_sha.update(tokens)
                    count += len(ids) // 4
                n.append(count)
                ids_hex.append(ids_sha.hexdigest())
                text_hex.append(text_sha.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return arrow_rows(docs.select(id_col, text_col), run, f"`{id_col}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
