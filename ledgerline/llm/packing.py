"""Best-fit packing of token sequences with large-item matching.

Only the histogram of piece lengths (at most ``capacity`` entries, whatever
the corpus) decides the packing, so it is planned once on the driver, on
counts instead of documents:

1. Pieces longer than a third of the capacity fit at most twice in a
   sequence.  From the longest down, each is paired with the longest other
   large piece that still fits beside it.
2. The other pieces, from the longest down, go where they leave the smallest
   gap; where none fits, a new sequence opens.

The plan is a list of slot ranges per length.  Documents find theirs by rank
among the pieces of the same length: each writing task numbers its own
pieces, and a running sum over tasks turns that into a global rank.  No task
ever holds all the pieces of one length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_rows, slices, staged
from ledgerline.llm.memo_encoder import memo_encoder

PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


def plan_sequences(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences for ``{length: count}``: ``(how many, [(length, times in each), ...])``."""
    left = {s: n for s, n in histogram.items() if n > 0}
    if left and (min(left) < 1 or max(left) > capacity):
        raise ValueError("lengths must lie between 1 and the capacity")
    gaps: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(many: int, items: list[tuple[int, int]]) -> None:
        gaps.setdefault(capacity - sum(s * k for s, k in items), []).append((many, items))

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        fits = bisect.bisect_right(large, capacity - a)
        b = large[fits - 1] if fits else None
        if b is None:
            put(left.pop(a), [(a, 1)])
            large.pop()
        elif b == a:
            if left[a] > 1:
                put(left[a] // 2, [(a, 2)])
            left[a] %= 2
            if not left[a]:
                large.pop()
            elif fits > 1:  # one is over: it goes with the next shorter
                b = large[fits - 2]
                put(1, [(a, 1), (b, 1)])
                large.pop()
                left[b] -= 1
                if not left[b]:
                    large.remove(b)
            else:
                put(1, [(a, 1)])
                large.pop()
        else:
            many = min(left[a], left[b])
            put(many, [(a, 1), (b, 1)])
            for s in (a, b):
                left[s] -= many
                if not left[s]:
                    large.remove(s)
    open_gaps = sorted(gaps)
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[s]
        while n:
            i = bisect.bisect_left(open_gaps, s)
            if i == len(open_gaps):
                many, items, gap = max(1, n // (capacity // s)), [], capacity
            else:
                gap = open_gaps[i]
                many, items = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], open_gaps[i]
            each = min(n, gap // s)
            used = min(many, n // each)
            if used < many and items:  # the rest of these sequences keeps its gap
                if gap not in gaps:
                    bisect.insort(open_gaps, gap)
                gaps.setdefault(gap, []).append((many - used, items))
            n -= used * each
            rest = gap - each * s
            if rest not in gaps:
                bisect.insort(open_gaps, rest)
            gaps.setdefault(rest, []).append((used, [*items, (s, each)]))
    return [c for g in sorted(gaps) for c in gaps[g]]


def slot_table(plan: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Slot ranges ``length, first rank, first sequence, slots in a sequence, offset``, by length and rank."""
    rows, ranks, sequence = [], Counter(), 0
    for many, items in plan:
        offset = 0
        for s, k in items:
            rows.append((s, ranks[s], sequence, k, offset))
            ranks[s] += many * k
            offset += s * k
        sequence += many
    rows.sort()
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of every document's ids and end id, with the writing task and the rank in it among equal lengths."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = memo_encoder(tokenizer_path)
        task, ranks = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, 256):
                row, piece, start, length, crc, rank = [], [], [], [], [], []
                for i, t in enumerate(part.column(1).to_pylist()):
                    ids = np.frombuffer(enc.encode(t or "") + end_id.to_bytes(4, "little"), "<u4")
                    first = len(ids) % capacity or capacity
                    edges = [0, *range(first, len(ids) + 1, capacity)]
                    for j in range(len(edges) - 1):
                        a, b = edges[j], edges[j + 1]
                        row.append(i)
                        piece.append(j)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].tobytes()))
                        rank.append(ranks[b - a])
                        ranks[b - a] += 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc)), pa.array([task] * len(row), pa.int64()), pa.array(rank, pa.int64())],
                    names=[id_col, "piece", "start", "length", "ids_crc32", "task", "rank"],
                )

    return docs.select(id_col, text_col).mapInArrow(cut, f"`{id_col}` {id_type}, {PIECES}, task bigint, rank bigint")


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents, each with its sequence and its place there.

    ``id_col, piece, start, length, ids_crc32, sequence_id, offset``.  A
    document is its ids and ``end_id``; null and empty texts are the end id
    alone.  Only documents longer than ``capacity`` are cut, the first piece
    taking the remainder.  Repeated and null ids are separate documents; an
    empty table packs into nothing.
    """
    pieces = staged(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    # at most `capacity` rows, whatever the corpus
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = slot_table(plan_sequences(histogram, capacity))
    before = F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    base = per_task.select("length", "task", F.coalesce(before, F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "task"]).select(
        id_col, "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank")
    )
    firsts = np.searchsorted(slots[:, 0], np.arange(capacity + 2))

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
        at = np.empty(len(length), dtype=np.int64)
        for s in np.unique(length):
            own, lo, hi = length == s, firsts[s], firsts[s + 1]
            at[own] = lo + np.searchsorted(slots[lo:hi, 1], rank[own], side="right") - 1
        _, first, sequence, each, offset = slots[at].T if len(at) else np.empty((5, 0), dtype=np.int64)
        within = rank - first
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(5)), pa.array(sequence + within // np.maximum(each, 1)), pa.array(offset + within % np.maximum(each, 1) * length)],
            names=[id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )

    id_type = docs.schema[id_col].dataType.simpleString()
    return arrow_rows(ranked, place, f"`{id_col}` {id_type}, {PIECES}, sequence_id bigint, offset bigint")
