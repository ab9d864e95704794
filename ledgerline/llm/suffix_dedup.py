"""Exact substring dedup with longest-previous-factor arrays.

Texts are bytes.  What matters are *windows*: all strings of ``min_bytes``
bytes.  A window belongs to its minimizer, the smallest hash of a ``seed``-byte
string in it (the leftmost of equal ones); equal windows have equal
minimizers.  Neighbouring windows with the same minimizer place form one
*block*, so a text becomes one block per few hundred bytes, and windows can
only repeat among the blocks of one minimizer.

1. Blocks with the same bytes are counted.  All windows of a block that
   occurs twice repeat.
2. Where a minimizer has several different blocks, their bytes are put into
   one string and its suffixes are sorted by prefix doubling.  Neighbours in
   suffix order that share ``min_bytes`` form clusters; in a cluster, the
   previous and the next smaller position in suffix order give a suffix its
   longest previous factor (``lpf_array`` does this for whole texts).
3. A minimizer with more than ``hot_blocks`` different blocks (a passage in
   very many surroundings) never meets in one task: its blocks are cut into
   pieces, at the same distances from the minimizer, and again into smaller
   ones.  All windows of a piece hold its *core*, so they can only repeat
   among pieces of the same core.  What stands alone there is left out,
   what is equal throughout is settled, and only the rest is cut on, down to
   single windows at last.

Each text then gets the runs of bytes that its repeated windows cover.  With
``keep_first`` the first occurrence of a string (smallest key, then place)
stays; otherwise all occurrences go.  Rows are matched by a digest of the
whole text, as equal texts have equal blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, bit_filter, slices

MIN_BYTES, SEED = 400, 48
#: Different blocks of one minimizer that are sorted in one task.
HOT_BLOCKS = 1024
#: Bytes of suffixes sorted at once.
SORT_BYTES = 1 << 20
#: Windows in a piece of a hot minimizer's block, round by round.
STEPS = (48, 6, 1)

_R = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all strings of ``width`` bytes, by differences of polynomial prefix sums."""
    n = len(data)
    if n < width:
        return np.empty(0, np.uint64)
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up = np.full(size + 1, _R, np.uint64)
        down = np.full(size + 1, pow(_R, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    up, down = _POWERS[size]
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    return _mix((sums[width:] - sums[:-width]) * down[: n - width + 1])


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_R))


#: Bits that hold a place next to a hash; longer texts are taken in stretches.
PLACE_BITS = 24


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value (by its upper 40 bits, then leftmost) in each run of ``width`` values."""
    n, most = len(x), 1 << PLACE_BITS
    if n < width:
        return np.empty(0, np.int64)
    if n > most:
        step = most - width + 1
        return np.concatenate([a + sliding_argmin(x[a : a + most], width) for a in range(0, n - width + 1, step)])
    pad = -n % width
    y = np.full(n + pad, np.iinfo(np.uint64).max, np.uint64)
    y[:n] = (x >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(n, dtype=np.uint64)
    y = y.reshape(-1, width)
    before = np.minimum.accumulate(y, axis=1).reshape(-1)  # from the start of a stretch
    after = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].reshape(-1)  # to its end
    low = np.minimum(after[: n - width + 1], before[width - 1 : n])
    return (low & np.uint64(most - 1)).astype(np.int64)


def blocks_of(data: bytes, min_bytes: int = MIN_BYTES, seed: int = SEED) -> Iterator[tuple[int, int, int]]:
    """``(minimizer, first byte, bytes)`` of each block; its windows are the ``bytes - min_bytes + 1`` it holds."""
    if len(data) < min_bytes:
        return
    h = window_hashes(np.frombuffer(data, np.uint8), seed)
    at = sliding_argmin(h, min_bytes - seed + 1)
    change = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    for a, b in zip(change.tolist(), np.r_[change[1:], len(at)].tolist()):
        yield int(h[at[a]].astype(np.int64)), a, b - a + min_bytes - 1


def suffix_array(x: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order of ``x`` (values from 1 up) by the first ``depth`` values at least, and the ranks by 1, 2, 4... values.

    Past the first sort, a rank is the place where its suffixes begin, so
    that only suffixes of equal rank are sorted again, among themselves.
    """
    n = len(x)
    rank = x.astype(np.int64)
    levels, k, key = [rank], 1, rank
    if int(rank.max(initial=0)) < 1 << 15:  # four values fit in one key: the first two rounds need no sorting
        for _ in range(2):
            after = np.zeros(n, np.int64)
            after[: max(0, n - k)] = key[k:]
            key = (key << (15 * k)) | after
            k *= 2
            levels.append(key)
    order = np.argsort(key)
    low = key[order]
    tied = np.arange(n)  # places in the order that are not settled
    new = np.r_[True, low[1:] != low[:-1]][:n]
    while True:
        rank = rank.copy() if len(tied) < n else np.empty(n, np.int64)
        begin = np.maximum.accumulate(np.where(new, tied + 1, 0))
        rank[order[tied]] = begin
        levels[-1] = rank
        tied = tied[~(new & np.r_[new[1:], True])]
        if k >= depth or not len(tied):
            return order, levels
        at = order[tied]
        second = np.zeros(len(at), np.int64)
        inside = at + k < n
        second[inside] = rank[at[inside] + k]
        key = rank[at] * (n + 1) + second
        by = np.argsort(key)
        order[tied] = at[by]
        low = key[by]
        new = np.r_[True, low[1:] != low[:-1]]
        levels.append(rank)
        k *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """For each place in suffix order, the values shared with the suffix before it (as far as ranks were told apart)."""
    n = len(order)
    out = np.zeros(n, np.int64)
    a, b = order[1:].copy(), order[:-1].copy()
    got = np.zeros(max(0, n - 1), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        while True:
            inside = (a < n) & (b < n)
            same = np.zeros(len(a), bool)
            same[inside] = levels[j][a[inside]] == levels[j][b[inside]]
            if not same.any():
                break
            for v in (a, b, got):
                v[same] += 1 << j
            if j < len(levels) - 1:
                break  # twice this length was told apart already
    out[1:] = got
    return out


def share(order: np.ndarray, levels: list[np.ndarray], width: int) -> np.ndarray:
    """For each place in suffix order, whether ``width`` values are shared with the suffix before it.

    Two strings of the longest length that was ranked and is no longer than
    ``width``, one at either end, cover them.
    """
    n, j = len(order), width.bit_length() - 1
    out = np.zeros(n, bool)
    if j >= len(levels):  # all suffixes were told apart by shorter strings
        return out
    a, b = order[1:], order[:-1]
    at = np.flatnonzero(levels[j][a] == levels[j][b])
    a, b, rest = a[at], b[at], width - (1 << j)
    inside = (a + rest < n) & (b + rest < n)
    at, a, b = at[inside], a[inside], b[inside]
    out[at[levels[j][a + rest] == levels[j][b + rest]] + 1] = True
    return out


def lpf_array(order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Longest previous factor of each position: the longest match that starts at a smaller position.

    The stack holds positions that rise along the suffix order; what a
    position meets below it is its previous, what removes it its next smaller
    position, and the smallest common prefix on the way is the match.
    """
    lpf = np.zeros(int(order.max(initial=-1)) + 1, np.int64)
    stack: list[list[int]] = []  # [position, prefix shared with the entry below]
    for p, common in zip(order.tolist(), shared.tolist()):
        while stack and stack[-1][0] > p:
            q, below = stack.pop()
            lpf[q] = max(lpf[q], below, common)  # previous smaller: below; next smaller: p
            common = min(common, below)
        if not stack:
            common = 0
        stack.append([p, common])
    for q, below in stack:
        lpf[q] = max(lpf[q], below)
    return lpf


def repeated_windows(texts: list[bytes], min_bytes: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For the windows of each text: whether each occurs at another place of any of the texts, and whether at an earlier one.

    A window occurs earlier if the longest previous factor of its position
    has ``min_bytes``; it occurs later if its cluster of suffixes sharing
    ``min_bytes`` holds a larger position.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(np.r_[0, lengths + 1])[:-1]
    x = np.zeros(int(lengths.sum()) + len(texts), np.int64)
    for k, (s, t) in enumerate(zip(starts, texts)):
        x[s : s + len(t)] = np.frombuffer(t, np.uint8).astype(np.int64) + 1 + len(texts)
        x[s + len(t)] = k + 1  # ends are all different, so no match crosses one
    order, levels = suffix_array(x, min_bytes)
    close = share(order, levels, min_bytes)
    members = np.flatnonzero(np.r_[close[1:], False] | close)
    anywhere, earlier = np.zeros(len(x), bool), np.zeros(len(x), bool)
    if len(members):
        at = order[members]
        # between clusters nothing is shared, and within one `min_bytes` is all that counts
        earlier[at] = lpf_array(at, np.where(close[members], min_bytes, 0))[at] >= min_bytes
        cluster = np.cumsum(~close[members])
        last = np.zeros(int(cluster[-1]) + 1, np.int64)
        np.maximum.at(last, cluster, at)
        anywhere[at] = earlier[at] | (at < last[cluster])
    return [tuple(f[s : s + max(0, n - min_bytes + 1)] for f in (anywhere, earlier)) for s, n in zip(starts, lengths)]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of true values as ``(first, end)``."""
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _blocks(docs: DataFrame, id_col: str, text_col: str, min_bytes: int) -> DataFrame:
    """``doc, key, h, b, start, size`` of the blocks of all texts; ``key`` and ``b`` digest the text and the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 256):
                row, key, cols = [], [], []
                for i, t in enumerate(part.column(1).to_pylist()):
                    data = (t or "").encode()
                    digest = hashlib.md5(data).digest()
                    for h, a, n in blocks_of(data, min_bytes):
                        row.append(i)
                        key.append(digest)
                        cols.append((h, xxhash.xxh3_64_intdigest(data[a : a + n]), a, n))
                h, b, a, n = zip(*cols) if cols else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row, pa.int64())),
                        pa.array(key, pa.binary()),
                        pa.array(h, pa.int64()),
                        pa.array(np.array(b, np.uint64).view(np.int64)),
                        pa.array(a, pa.int32()),
                        pa.array(n, pa.int32()),
                    ],
                    names=["doc", "key", "h", "b", "start", "size"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc {id_type}, key binary, h bigint, b bigint, start int, size int")


def _contents(docs: DataFrame, text_col: str, min_bytes: int, wanted: DataFrame) -> DataFrame:
    """``h, b, bytes`` of the wanted blocks, and maybe of a few more: a bit filter of bounded size says which."""
    shared, bits = bit_filter(wanted, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, low = shared.value, (1 << bits) - 1
        for batch in batches:
            for part in slices(batch, 64):
                hs, bs, out = [], [], []
                for t in part.column(0).to_pylist():
                    data = (t or "").encode()
                    for h, a, n in blocks_of(data, min_bytes):
                        content = data[a : a + n]
                        b = xxhash.xxh3_64_intdigest(content)
                        if int(have[(b & low) >> 6]) >> (b & 63) & 1:
                            hs.append(h)
                            bs.append(b)
                            out.append(content)
                yield pa.RecordBatch.from_arrays([pa.array(hs, pa.int64()), pa.array(np.array(bs, np.uint64).view(np.int64)), pa.array(out, pa.binary())], names=["h", "b", "bytes"])

    return docs.select(text_col).mapInArrow(run, "h bigint, b bigint, bytes binary").groupBy("h", "b").agg(F.first("bytes").alias("bytes"))


RANGES = "array<struct<first:int,end:int>>"


def _sorted_ranges(blocks: DataFrame, min_bytes: int, total_bytes: int) -> DataFrame:
    """``h, b, anywhere, earlier``: runs of repeated windows in blocks ``h, b, bytes, doc, key, start`` that meet by minimizer."""
    bins = max(1, -(-2 * total_bytes // SORT_BYTES))

    def sort(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        # suffix positions rise with the first occurrence, so that "previous" means earlier in the corpus
        rows.sort(key=lambda r: (r["h"], r["doc"] is not None, r["doc"], r["key"], r["start"]))
        out = repeated_windows([r["bytes"] for r in rows], min_bytes)
        as_rows = lambda f: [{"first": a, "end": e} for a, e in runs(f)]
        kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        return pa.table(
            {
                "h": pa.array([r["h"] for r in rows], pa.int64()),
                "b": pa.array([r["b"] for r in rows], pa.int64()),
                "anywhere": pa.array([as_rows(x) for x, _ in out], kind),
                "earlier": pa.array([as_rows(y) for _, y in out], kind),
            }
        )

    return blocks.groupBy(F.pmod(F.xxhash64("h"), F.lit(bins)).alias("bin")).applyInArrow(sort, f"h bigint, b bigint, anywhere {RANGES}, earlier {RANGES}")


def pieces_of(data: bytes, place: int, parts: list[tuple[int, int, int]], min_bytes: int, step: int) -> Iterator[tuple[int, int, int, int]]:
    """``(first window, windows, core, content)`` of the pieces of a block whose minimizer is at ``place``.

    ``parts`` are its ``(first window, windows, core)`` that are still in
    question; a piece holds at most ``step`` windows, and none that are
    ``step`` or more apart in their distance from the minimizer.
    """
    for first, many, core in parts:
        for k in range((place - first - many + 1) // step, (place - first) // step + 1):
            low, high = place - (k + 1) * step + 1, place - k * step  # windows of any block that lie so far ahead of its minimizer
            a, z = max(first, low), min(first + many - 1, high)
            g = xxhash.xxh3_64_intdigest(data[high : low + min_bytes], (core * 0x9E3779B1 + k) & 0xFFFFFFFFFFFFFFFF)
            yield a, z - a + 1, g, xxhash.xxh3_64_intdigest(data[a : z + min_bytes])


def _hot_ranges(blocks: DataFrame, min_bytes: int, scratch: Scratch) -> DataFrame:
    """The same for blocks of hot minimizers: pieces of equal cores meet, in rounds of smaller and smaller ones."""
    doc = blocks.schema["doc"].dataType.simpleString()
    own = ["h", "b", "doc", "key", "start"]
    blocks, _ = scratch.write(blocks.select(*own, "bytes"))
    todo = blocks.withColumn("parts", F.array(F.struct(F.lit(0).alias("at"), (F.octet_length("bytes") - (min_bytes - 1)).alias("many"), F.col("h").alias("g"))))
    place = F.struct("doc", "key", "start", "at")
    hits = []

    def cut(step: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, 256):
                    row, cols = [], []
                    for i, (data, parts) in enumerate(zip(part.column(5).to_pylist(), part.column(6).to_pylist())):
                        at = int(sliding_argmin(window_hashes(np.frombuffer(data[:min_bytes], np.uint8), SEED), min_bytes - SEED + 1)[0])
                        cols += pieces_of(data, at, [(x["at"], x["many"], x["g"]) for x in parts], min_bytes, step)
                        row += [i] * (len(cols) - len(row))
                    at, many, g, c = (np.array(x, np.uint64) for x in (zip(*cols) if cols else ((),) * 4))
                    taken = [part.column(j).take(pa.array(row, pa.int64())) for j in range(5)]
                    yield pa.RecordBatch.from_arrays(
                        [*taken, *(pa.array(x.astype(np.int32)) for x in (at, many)), *(pa.array(x.view(np.int64)) for x in (g, c))], names=[*own, "at", "many", "g", "c"]
                    )

        return run

    for step in STEPS:
        pieces = todo.select(*own, "bytes", "parts").mapInArrow(cut(step), f"h bigint, b bigint, doc {doc}, key binary, start int, at int, many int, g bigint, c bigint")
        pieces, path = scratch.write(pieces)
        per = pieces.groupBy("h", "g", "c").agg(F.min(place).alias("one"), F.count(F.lit(1)).alias("n"))
        kinds = per.groupBy("h", "g").agg(F.count(F.lit(1)).alias("kinds"))
        met = pieces.join(per.join(kinds, ["h", "g"]).where("n > 1 or kinds > 1"), ["h", "g", "c"]).withColumn("later", ~place.eqNullSafe(F.col("one")))
        met, _ = scratch.write(met.select("h", "b", "at", "many", "g", "n", "kinds", "later"))
        scratch.release(path)
        hits.append(met.where("n > 1").select("h", "b", "at", (F.col("at") + F.col("many")).alias("end"), "later"))
        # of equal pieces, the first stands for all among those of the same core
        rest = met.where("kinds > 1 and not later").groupBy("h", "b").agg(F.collect_list(F.struct("at", "many", "g")).alias("parts"))
        todo = blocks.join(rest, ["h", "b"])
    hit = hits[0]
    for more in hits[1:]:
        hit = hit.union(more)
    one = F.struct(F.col("at").alias("first"), F.col("end"))
    return hit.groupBy("h", "b").agg(
        F.sort_array(F.collect_list(one)).cast(RANGES).alias("anywhere"),
        F.sort_array(F.collect_list(F.when(F.col("later"), one))).cast(RANGES).alias("earlier"),
    )


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES, keep_first: bool = True, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """``key`` (MD5 of a text; with ``keep_first`` also ``doc``) and ``spans``: the byte runs that its repeated windows cover.

    Only texts with such a run have a row.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    blocks, _ = scratch.write(_blocks(docs, id_col, text_col, min_bytes))
    per = blocks.groupBy("h", "b").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "key", "start")).alias("one"), F.max("size").alias("size"))
    many = per.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("single"))
    # what is not here is a block that occurs once, alone with its minimizer
    per, _ = scratch.write(per.join(many, "h").where("n > 1 or kinds > 1"))
    # where all blocks repeat whole, there is nothing to tell but which of them comes first
    mixed = per.where("kinds > 1").where((F.col("single") > 0) | F.lit(keep_first))
    total = mixed.where(F.col("kinds") <= hot_blocks).agg(F.sum("size").alias("s")).first()["s"] or 0
    contents, _ = scratch.write(_contents(docs, text_col, min_bytes, mixed))
    full = mixed.select("h", "b", "kinds", "one.*").join(contents, ["h", "b"])
    ranges = _sorted_ranges(full.where(F.col("kinds") <= hot_blocks).drop("kinds"), min_bytes, total).union(
        _hot_ranges(full.where(F.col("kinds") > hot_blocks), min_bytes, scratch)
    )
    empty = F.array().cast(RANGES)
    whole = F.array(F.struct(F.lit(0).alias("first"), (F.col("size") - (min_bytes - 1)).alias("end"))).cast(RANGES)
    judged = per.join(ranges, ["h", "b"], "left").select(
        "h",
        "b",
        F.col("one.doc").alias("one_doc"),
        F.col("one.key").alias("one_key"),
        F.col("one.start").alias("one_start"),
        F.when(F.col("n") > 1, whole).otherwise(F.coalesce("anywhere", empty)).alias("anywhere"),
        F.coalesce("earlier", empty).alias("earlier"),
    ).where(F.size("anywhere") > 0)
    judged, _ = scratch.write(judged)
    found = blocks.join(judged, ["h", "b"])
    if keep_first:
        first = F.col("doc").eqNullSafe(F.col("one_doc")) & (F.col("key") == F.col("one_key")) & (F.col("start") == F.col("one_start"))
        cut, by = F.when(first, F.col("earlier")).otherwise(F.col("anywhere")), ["doc", "key"]
    else:
        cut, by = F.col("anywhere"), ["key"]
    pieces = found.select(*by, F.col("start").alias("s"), cut.alias("cut")).distinct().select(*by, "s", F.explode("cut").alias("r"))
    spans = pieces.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct((F.col("s") + F.col("r.first")).alias("start"), (F.col("s") + F.col("r.end") + (min_bytes - 1)).alias("end")))).alias("spans")
    )
    return scratch.write(spans)[0]


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES, keep_first: bool = True, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every text: ``kept`` is what remains, as bytes.

    Every byte covered by a string of ``min_bytes`` bytes that also starts at
    another place of the corpus is removed; with ``keep_first`` only where
    the string starts at an earlier place (by id, then digest, then place).
    Null texts are empty.  Null and repeated ids keep a row each; with
    ``keep_first``, rows that repeat both id and text count as one document.
    An empty table gives an empty result.
    """
    spans = repeated_spans(docs, id_col, text_col, min_bytes, keep_first, hot_blocks)
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    there = F.col("digest") == F.col("key")
    if keep_first:
        there &= F.col("id").eqNullSafe(F.col("doc"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 256):
                n, gone, many, sha, kept = [], [], [], [], []
                for text, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    data, end, out, removed, stretches = text.encode(), 0, [], 0, 0
                    for r in found or ():
                        if r["start"] > end or not stretches:
                            out.append(data[end : r["start"]])
                            stretches += 1
                            removed += r["end"] - r["start"]
                            end = r["end"]
                        elif r["end"] > end:
                            removed += r["end"] - end
                            end = r["end"]
                    out.append(data[end:])
                    kept.append(b"".join(out))
                    n.append(len(data))
                    gone.append(removed)
                    many.append(stretches)
                    sha.append(hashlib.sha256(kept[-1]).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(x, pa.int64()) for x in (n, gone, many)), pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
                    names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return own.join(spans, there, "left").select("id", "text", "spans").mapInArrow(cut, schema)
