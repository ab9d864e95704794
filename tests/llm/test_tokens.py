"""Token counts, packing and streaming BPE against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from ledgerline.llm.bpe_stream import StreamCodec, WordTransducer, encode_decode
from ledgerline.llm.memo_encoder import MemoEncoder, byte_characters
from ledgerline.llm.packing import pack_documents, plan_sequences
from ledgerline.llm.registry import BYTE_BPE, WORD_BPE, tokenizer_file
from ledgerline.llm.token_counts import ChunkedEncoder, token_counts
from tests.llm.helpers import DOCS, corpus, make_docs

SPECIAL = [(900, "a<|endoftext|>b <|endoftext|>"), (901, "don't  stop\n\n\tx' 'S 12345 <|startoftext|> ΣΑΣ İ é"), (902, "\x1c\x85\xa0 a")]


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(tokenizer_file(BYTE_BPE))


@pytest.fixture(scope="module")
def word_bpe():
    return Tokenizer.from_file(tokenizer_file(WORD_BPE))


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def key(row):
    return (row[0] is not None, row[0] or 0, *row[1:])


def test_counts(spark, byte_bpe):
    rows = corpus() + SPECIAL
    got = token_counts(make_docs(spark, rows), tokenizer_file(BYTE_BPE), chunk_chars=600, overlap_chars=64).collect()
    want = [(i, len((t or "").encode()), n := len(ids(byte_bpe, t)), n > 1024) for i, t in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("chunk", [90, 200, 1000])
def test_chunks_splice_like_whole_texts(byte_bpe, chunk):
    rng = random.Random(chunk)
    enc = ChunkedEncoder(tokenizer_file(BYTE_BPE), chunk_chars=chunk, overlap_chars=40)
    for _ in range(40):
        pieces = ["the ", "a" * rng.randint(1, 300), " " * rng.randint(1, 60), "\n", "'ll", "12345", "é中", "<|endoftext|>", ".,!", "x y "]
        text = "".join(rng.choice(pieces) for _ in range(120))
        assert np.concatenate([*enc.encode_long(text)]).tolist() == ids(byte_bpe, text)
        assert enc.count_batch([text, ""]) == [len(ids(byte_bpe, text)), 0]


def test_memo_encoder(byte_bpe):
    enc, rng = MemoEncoder(tokenizer_file(BYTE_BPE)), random.Random(5)
    alphabet = "abc d  e\n\n\t'sdlverm.,!?0123éß　中\x85\xa0\x1c#<"
    for _ in range(2000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) + rng.choice(["", "<|endoftext|> x"])
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == ids(byte_bpe, text)


def test_memo_keeps_spaced_runs_once(byte_bpe):
    enc, rng = MemoEncoder(tokenizer_file(BYTE_BPE)), random.Random(23)
    for _ in range(300):
        text = "".join(chr(rng.choice([rng.randrange(128), 32, 32, rng.randrange(97, 123), rng.randrange(48, 58), 0xE9, 0x2003, 0x1F600])) for _ in range(rng.randrange(40)))
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == ids(byte_bpe, text), repr(text)
    enc = MemoEncoder(tokenizer_file(BYTE_BPE))
    enc.encode("One two three four one two")
    assert len(enc.words) + len(enc.runs) + len(enc.spaced) == 6  # One as a word and a run, four others; ten before


def test_whole_texts_are_counted_from_the_memo(byte_bpe):
    enc = ChunkedEncoder(tokenizer_file(BYTE_BPE))
    enc.tokenizer = None  # the library encodes only what is longer than a chunk
    texts = [t or "" for _, t in corpus() + SPECIAL]
    assert enc.count_batch(texts) == [len(ids(byte_bpe, t)) for t in texts]


def test_packing(spark, byte_bpe):
    rows, capacity = corpus() + SPECIAL, 256
    got = pack_documents(make_docs(spark, rows), tokenizer_file(BYTE_BPE), capacity=capacity).collect()
    want = []
    for i, t in rows:
        x = [*ids(byte_bpe, t), 0]
        first = len(x) % capacity or capacity
        edges = [0, *range(first, len(x) + 1, capacity)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1]] and sum(n for _, n in places) <= capacity
    assert len(sequences) <= -(-sum(r["length"] for r in got) // capacity) + 1


def test_plan_uses_every_length_once():
    rng = random.Random(2)
    for capacity in (10, 64, 2048):
        for _ in range(30):
            histogram = {rng.randint(1, capacity): rng.randint(1, 500) for _ in range(rng.randint(0, 40))}
            used = {}
            for many, items in plan_sequences(histogram, capacity):
                assert many > 0 and sum(s * k for s, k in items) <= capacity
                assert sum(k for s, k in items if 3 * s > capacity) <= 2
                for s, k in items:
                    used[s] = used.get(s, 0) + many * k
            assert used == histogram


def test_stream_codec_query(spark, word_bpe):
    rows = corpus() + SPECIAL
    got = encode_decode(make_docs(spark, rows), tokenizer_file(WORD_BPE)).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(x := ids(word_bpe, t)), sha(np.array(x, "<u4").tobytes()), sha(word_bpe.decode(x, skip_special_tokens=False).encode())) for i, t in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_stream_codec_slices_and_lookahead(word_bpe):
    codec, rng = StreamCodec(tokenizer_file(WORD_BPE), slice_chars=50, memo_words=20), random.Random(9)
    assert codec.merges.proper and 1 < codec.merges.lookahead < 2000
    for _ in range(150):
        text = "".join(rng.choice("aehtn' \n.é́ΣİÄ1<中") for _ in range(rng.randint(0, 400)))
        assert codec.encode_ids(text).tolist() == ids(word_bpe, text)
        assert b" ".join(t for _, t in codec.encode(text)).decode() == word_bpe.decode(ids(word_bpe, text), skip_special_tokens=False)
    for letters in ("a", "ab", "aehtnisrol"):
        word = "".join(rng.choice(letters) for _ in range(4000))
        t = WordTransducer(codec.merges, block=32)
        out, most = [], 0
        for b in word.encode():
            out += t.feed(bytes([b]))
            most = max(most, len(t.buffer))
        assert [*out, *t.finish()] == ids(word_bpe, word)
        assert most <= 32 + codec.merges.lookahead + 1  # memory does not grow with the pre-token


def test_decoded_text_round_trip():
    codec = StreamCodec(tokenizer_file(WORD_BPE))
    for text in ("hello world é 中文", "a b c", "<|endoftext|>"):
        out = "".join(codec.decode_text(codec.encode_ids(text)))
        assert out.split() == text.split()
    assert "".join(codec.decode_text(codec.encode_ids("é")[:0])) == ""


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert token_counts(none, tokenizer_file(BYTE_BPE)).count() == 0
    assert encode_decode(none, tokenizer_file(WORD_BPE)).count() == 0
    assert pack_documents(none, tokenizer_file(BYTE_BPE)).count() == 0


def test_bytes_are_spelt_as_the_library_does():
    assert {chr(c) for c in byte_characters().values()} == {*ByteLevel.alphabet()}
    path = tokenizer_file(BYTE_BPE)
    library, ours = Tokenizer.from_file(path), MemoEncoder(path)
    for word in (*map(chr, range(256)), " caf\u00e9", "\u4e2d\u6587", "\U0001f600", "x" * 3000, " a1b2-c3"):
        assert np.frombuffer(ours._word(word), "<u4").tolist() == [t.id for t in library.model.tokenize(ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(word)[0][0])]
