"""Byte-level BPE ids with a memo of pre-token runs.

Texts consist of runs that begin at a single space (or at the text's start)
and hold no other space.  The splitting pattern cannot look across such a
start, as a pre-token that begins at a space never holds what lies before it,
so runs are encoded on their own and remembered.  Texts with two white spaces
in a row, where the pattern does look ahead, are cut by the pattern itself.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import regex

from ledgerline.llm.bpe_stream import WHITE

#: The pattern of byte-level pre-tokens (a fixed value of the vocabulary file's pre-tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 400_000
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4


def byte_characters() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    own = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(others)}


def memo_fits(spec: dict) -> bool:
    """Whether a tokenizer file is byte-level BPE of the usual pattern, whose special strings stand for themselves wherever they are."""
    pre, plain = spec["pre_tokenizer"] or {}, not any(t.get(k) for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word"))
    return spec["normalizer"] is None and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre["use_regex"] and spec["model"]["type"] == "BPE" and plain


class _Memo(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        found = self.make(key)
        if len(key) <= 64:
            self[key] = found
        return found


class MemoEncoder:
    """Ids of whole texts as little-endian 32-bit integers."""

    def __init__(self, tokenizer_path: str):
        from tokenizers import Regex, Tokenizer
        from tokenizers.pre_tokenizers import Split

        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        if not memo_fits(spec):
            raise ValueError("a byte-level file without normalizer and prefix space is expected")
        # the library's own merging of one pre-token, whose bytes its vocabulary spells as characters
        self.merge = Tokenizer.from_file(tokenizer_path).model.tokenize
        self.spelt = byte_characters()
        white = f"[{WHITE}]"
        ours = PATTERN.replace(r"[^\s", "[^" + WHITE).replace(r"(?!\S)", f"(?![^{WHITE}])").replace(r"\s+", white + "+")
        self.split = regex.compile(ours).findall
        # the same on ASCII alone, where Python's own expressions are faster
        ascii_only = ours.replace(r"\p{L}\p{N}", "A-Za-z0-9").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self.ascii_split = re.compile(ascii_only).findall
        self.space = chr(self.spelt[ord(" ")])
        self.double = re.compile(white + white)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # characters on which this Python and the library follow different versions of Unicode
        self.own_split = Split(Regex(PATTERN), "isolated")
        every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        differ = {c for c in every if unicodedata.category(c) == "Cn"}
        known = "".join(c for c in every if c not in differ and unicodedata.category(c) != "Co")
        for kind in ("L", "N"):
            theirs = {t for t, _ in Split(Regex(rf"\p{{{kind}}}"), "removed", invert=True).pre_tokenize_str(known)}
            differ |= {*regex.findall(rf"\p{{{kind}}}", known)} ^ theirs
        self.differs = frozenset(differ)
        self.words, self.runs = _Memo(self._word), _Memo(self._run)
        self.spaced = _Memo(lambda run: self._run(" " + run))  # by what follows the space

    def _word(self, word: str) -> bytes:
        # printable ASCII but the space stands for itself
        spelt = word.replace(" ", self.space) if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.spelt)
        ids = [t.id for t in self.merge(spelt)]
        return array("I", ids).tobytes() if LITTLE else np.array(ids, "<u4").tobytes()

    def _cut(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_split(text)
        if not self.differs.isdisjoint(text):
            return [t for t, _ in self.own_split.pre_tokenize_str(text)]
        return self.split(text)

    def _run(self, run: str) -> bytes:
        if run[0] == " " and run[1:].isalpha() and (run.isascii() or self.differs.isdisjoint(run)):
            return self._word(run)  # kept as a run
        return b"".join(map(self.words.__getitem__, self._cut(run)))

    def encode(self, text: str) -> bytes:
        if self.special and any(s in text for s in self.special):
            parts = self.special_split.split(text)
            return b"".join(self.special[p].to_bytes(4, "little") if i % 2 else self.encode(p) for i, p in enumerate(parts) if p)
        if not text:
            return b""
        for memo in (self.words, self.runs, self.spaced):
            if len(memo) > MEMO:
                memo.clear()
        if self.double.search(text):
            return b"".join(map(self.words.__getitem__, self._cut(text)))
        runs, spaced, out = self.runs, self.spaced.__getitem__, []
        # with single white spaces only, a line break is a pre-token of its own as well
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(self.words["\n"])
            if line:
                first, *rest = line.split(" ")
                if first:
                    out.append(runs[first])
                out += map(spaced, rest)
        return b"".join(out)


@lru_cache(maxsize=2)
def memo_encoder(tokenizer_path: str) -> MemoEncoder:
    """One encoder per Python worker and file."""
    return MemoEncoder(tokenizer_path)
