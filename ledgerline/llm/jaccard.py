"""N-gram Jaccard join by rare-first prefix filtering.

A document is the set of its word n-grams (64-bit hashes).  Sets are ordered
rarest gram first, so that two sets whose Jaccard similarity reaches the
threshold share a gram within their first few.  Frequencies come from a
sketch of fixed size over all documents; any order is right, a good one only
keeps posting lists short.

Equal sets form a class; only classes are joined, on their prefix grams.
Candidates pass the length filter, the positional filter (what can still be
shared before and after the common gram) and the suffix filter (sets cut into
hash ranges; the differences of the ranges' sizes, or of their parities, bound
the sets' difference from below), and each pair is verified once on the whole
sets.

Because components are asked for, not all links, the join runs in two steps
that lose none of them:

1. Each posting list is joined to its smallest member only.  Verified links
   already make one component of a large group of near copies.
2. Lists of three members or more that still hold several components are
   joined within themselves, leaving out pairs inside a component (the one
   pair of a shorter list has been judged).  The members of a list's largest
   component stand on one side only, so a list made of one large group and a
   few strays costs strays x list, not the square of the list.  A pair that
   shares one of the few grams ahead of the common one is left to that one's
   list, as near copies share most of their first grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import Scratch, bit_filter, drop_unused, let_through, slices, staged
from ledgerline.llm.components import components

#: Counters of the frequency sketch and how many of them travel in a row; both fixed, so is what is broadcast.
SKETCH_BITS, BLOCK = 20, 4096
PARTS = 64
#: Grams ahead of a common one in which a pair is looked for before it is made.
AHEAD = 8
MEMO_WORDS = 1 << 17


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


_WORDS = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams; a shorter text is one gram, one without words none.

    A-Z are lower-cased; words are runs of anything but ASCII white space.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_WORDS) > MEMO_WORDS:
        _WORDS.clear()
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(width, len(h))
    g = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        g = _mix(g * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
    return np.unique(g)


def signature(grams: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None


def prefix_length(n: int, percent: int) -> int:
    """How many of the first grams of a set of ``n`` must hold one that any linked set holds as well."""
    return n - -(-percent * n // 100) + 1


def odd_columns(percent: int) -> list[str]:
    """Columns of 64 bits each that tell which hash ranges hold an odd number of a set's grams.

    Two differing grams in one range hide each other.  Those pairs grow with
    the square of how much linked sets may differ, so the ranges do as well:
    256 for nine tenths in common, 1024 for eight tenths or less.
    """
    share = 100 - percent
    return [f"o{i}" for i in range(4 if share <= 10 else 8 if share <= 15 else 16)]


def _key(column: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{column}`"), F.lit("")))


def _sketch(docs: DataFrame, text_col: str, width: int) -> np.ndarray:
    """Document frequencies by hash bucket: tasks count, blocks of counters are summed in two rounds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for part in slices(batch, 256):
                g = [gram_set(t, width) for t in part.column(0).to_pylist()]
                if g:
                    total += np.bincount((np.concatenate(g) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total)).astype(np.uint32)
        task = TaskContext.get().partitionId() % 64
        blocks = total.reshape(-1, BLOCK)
        at = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array([task] * len(at), pa.int64()), pa.array([blocks[i].tobytes() for i in at], pa.binary())], names=["block", "salt", "counts"]
        )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, np.uint64)
        for c in table.column("counts"):
            total += np.frombuffer(c.as_py(), np.uint32)
        total = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int64()), "salt": pa.array([0], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "block bigint, salt bigint, counts binary"
    parts = docs.select(text_col).mapInArrow(count, schema).groupBy("block", "salt").applyInArrow(add, schema)
    out = np.zeros((1 << SKETCH_BITS) // BLOCK * BLOCK, np.uint32).reshape(-1, BLOCK)
    # a row for each block: 4 MB whatever the corpus
    for r in parts.groupBy("block").applyInArrow(add, schema).collect():
        out[r["block"]] = np.frombuffer(r["counts"], np.uint32)
    return out.reshape(-1)


def _profiles(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """``doc, key, n, sig, prefix, parts`` and the odd ranges of every document; ``prefix`` is empty without words."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    odds = odd_columns(percent)
    ranges = 64 * len(odds)
    shift = np.uint64(64 - (ranges - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = shared.value
        for batch in batches:
            for part in slices(batch, 256):
                n, sig, ends, prefixes, parts, bits = [], [], [0], [], [], []
                for t in part.column(1).to_pylist():
                    g = gram_set(t, width)
                    order = np.lexsort((g, df[(g >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))
                    first = g[order[: prefix_length(len(g), percent)]] if len(g) else g
                    n.append(len(g))
                    sig.append(signature(g))
                    prefixes.append(first.view(np.int64))
                    ends.append(ends[-1] + len(first))
                    # counts above 127 may count as 127: their difference only gets smaller
                    parts.append(np.minimum(np.bincount((g >> np.uint64(58)).astype(np.int64), minlength=PARTS), 127).astype(np.int8))
                    bits.append(np.packbits(np.bincount((g >> shift).astype(np.int64), minlength=ranges) & 1).view(np.int64))
                odd = np.concatenate([*bits, np.empty(0, np.int64)]).reshape(-1, len(odds))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(n, pa.int64()),
                        pa.array(sig, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*prefixes, np.empty(0, np.int64)]), pa.int64())),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * PARTS, pa.int32()), pa.array(np.concatenate([*parts, np.empty(0, np.int8)]), pa.int8())),
                        *(pa.array(odd[:, i]) for i in range(len(odds))),
                    ],
                    names=["doc", "key", "n", "sig", "prefix", "parts", *odds],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col, _key(text_col)).mapInArrow(run, f"doc {id_type}, key bigint, n bigint, sig binary, prefix array<bigint>, parts array<tinyint>, " + ", ".join(f"{c} bigint" for c in odds))


def _sets(docs: DataFrame, text_col: str, width: int, wanted: DataFrame) -> DataFrame:
    """``sig, grams`` of the texts whose ``key`` is in ``wanted``, and maybe of a few more: a bit filter of bounded size says which."""
    shared, bits = bit_filter(wanted, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 256):
                sigs, grams, ends = [], [], [0]
                for t in let_through(part, 0, shared.value, bits).column(1).to_pylist():
                    g = gram_set(t, width)
                    sig = signature(g)
                    if sig is None:
                        continue
                    sigs.append(sig)
                    grams.append(g.view(np.int64))
                    ends.append(ends[-1] + len(g))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sigs, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*grams, np.empty(0, np.int64)]), pa.int64()))],
                    names=["sig", "grams"],
                )

    return docs.select(_key(text_col).alias("key"), text_col).mapInArrow(run, "sig binary, grams array<bigint>").groupBy("sig").agg(F.first("grams").alias("grams"))


def _least_overlap(n: Column, m: Column, percent: int) -> Column:
    """Common grams that sets of ``n`` and ``m`` need: ceil(p (n + m) / (100 + p))."""
    return F.floor((percent * (n + m) + 99 + percent) / (100 + percent))


def _fits(n: Column, i: Column, m: Column, j: Column, percent: int) -> Column:
    """Length and positional filter for a common gram at places ``i`` and ``j``."""
    room = 1 + F.least(i, j) + F.least(n - i, m - j) - 1
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (room >= _least_overlap(n, m, percent))


def _odd_apart(x: str, y: str, percent: int) -> Column:
    """Parity filter: every gram that only one set has turns the parity of one range."""
    apart = sum((F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in odd_columns(percent)), F.lit(0))
    return apart <= F.col(f"{x}.n") + F.col(f"{y}.n") - 2 * _least_overlap(F.col(f"{x}.n"), F.col(f"{y}.n"), percent)


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text_col: str, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """The linked among candidate ``a, b`` (class ids): suffix filter, then the whole sets."""
    side = lambda c: classes.select(F.col("cid").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in ("n", "parts", "sig", "key")))
    apart = F.aggregate(F.zip_with("parts_a", "parts_b", lambda x, y: F.abs(x.cast("int") - y.cast("int"))), F.lit(0), lambda acc, x: acc + x)
    need = _least_overlap(F.col("n_a"), F.col("n_b"), percent)
    left = pairs.join(side("a"), "a").join(side("b"), "b").where(apart <= F.col("n_a") + F.col("n_b") - 2 * need).drop("parts_a", "parts_b")
    left, left_path = scratch.write(left)
    # one text of each class is enough
    wanted = left.select(F.col("key_a").alias("key")).union(left.select(F.col("key_b").alias("key"))).distinct()
    sets, sets_path = scratch.write(_sets(docs, text_col, width, wanted))
    of = lambda c: sets.select(F.col("sig").alias(f"sig_{c}"), F.col("grams").alias(f"grams_{c}"))
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    links = left.join(of("a"), "sig_a").join(of("b"), "sig_b").where((100 + percent) * common >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")
    links, _ = scratch.write(links)
    for path in (left_path, sets_path):
        scratch.release(path)
    return links


def _open_lists(lists: DataFrame, links: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """``gram, cid, n, i, root, main`` of the lists that hold several components; ``main`` is the root of most members."""
    roots = components(links, scratch).withColumnRenamed("node", "cid")
    members = lists.select("gram", "cid", "n", "i").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    per = members.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("k")).groupBy("gram").agg(F.max_by("root", "k").alias("main"), F.count(F.lit(1)).alias("roots"))
    return scratch.write(members.join(per.where("roots > 1").select("gram", "main"), "gram"))


def _within(told: DataFrame, percent: int) -> DataFrame:
    """``a, b``: the pairs of open lists that are in two components and may be linked; few come twice."""
    x, y = told.where("root <> main").alias("x"), told.alias("y")
    once = (F.col("y.root") == F.col("y.main")) | (F.col("x.cid") < F.col("y.cid"))
    fits = _fits(F.col("x.n"), F.col("x.i"), F.col("y.n"), F.col("y.i"), percent)
    # linked sets of two components pass the filters in the list of every gram that their prefixes share
    new = ~F.arrays_overlap("x.ahead", "y.ahead")
    pairs = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.root") != F.col("y.root")) & once & fits & _odd_apart("x", "y", percent) & new)
    return pairs.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b"))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """``doc, n, sig, component`` of every document.

    ``component`` is the smallest id reachable by links between sets whose
    Jaccard similarity is ``percent`` hundredths or more (exact on 64-bit gram
    hashes).  Documents without words have ``n`` 0, no signature and are
    linked with nothing.  Rows with a null id link like others; repeated ids
    and rows are separate documents of the same set; a component of null ids
    alone has none.  An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    profiles, _ = scratch.write(_profiles(docs, id_col, text_col, width, percent, _sketch(docs, text_col, width)))
    first = [F.first(c).alias(c) for c in ("key", "n", "prefix", "parts", *odd_columns(percent))]
    classes = profiles.where("n > 0").groupBy("sig").agg(F.min("doc").alias("doc"), *first)
    classes, _ = scratch.write(classes.withColumn("cid", F.monotonically_increasing_id()))

    postings = classes.select("cid", "n", F.posexplode("prefix").alias("i", "gram"))
    hubs = postings.groupBy("gram").agg(F.min(F.struct("cid", "n", "i")).alias("hub"), F.count(F.lit(1)).alias("many")).where("many > 1")
    lists, lists_path = scratch.write(postings.join(hubs, "gram"))
    fits = _fits(F.col("n"), F.col("i"), F.col("hub.n"), F.col("hub.i"), percent)
    pairs = lists.where(F.col("cid") != F.col("hub.cid")).where(fits).select(F.col("hub.cid").alias("a"), F.col("cid").alias("b")).distinct()
    links = _verified(pairs, classes, docs, text_col, width, percent, scratch)

    # linked sets pass the filter above in every list that holds both, so two members alone are settled
    still, still_path = _open_lists(lists.where("many > 2"), links, scratch)
    scratch.release(lists_path)
    ahead = F.slice("prefix", F.greatest(F.col("i") - (AHEAD - 1), F.lit(1)), F.least(F.col("i"), F.lit(AHEAD)))
    told, _ = scratch.write(still.join(classes.select("cid", "prefix", *odd_columns(percent)), "cid").withColumn("ahead", ahead).drop("prefix"))
    scratch.release(still_path)
    links = links.union(_verified(_within(told, percent).distinct(), classes, docs, text_col, width, percent, scratch))

    roots = components(links, scratch).withColumnRenamed("node", "cid")
    rooted = classes.select("cid", "sig", "doc").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    smallest = rooted.groupBy("root").agg(F.min("doc").alias("component"))
    by_sig = rooted.select("sig", "root").join(smallest, "root").select("sig", "component")
    groups = profiles.select("doc", "n", "sig").join(by_sig, "sig", "left").select(
        "doc", "n", "sig", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component")
    )
    # a table of its own, so that nothing else has to stay on disk
    groups = staged(groups, "groups")
    scratch.release(scratch.base)
    drop_unused(docs.sparkSession)
    return groups


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the document of smallest id of each component; those without words all stay.

    Of rows that repeat both id and set, one stays; in a component of null
    ids alone, one row of each set does.
    """
    groups = similar_groups(docs, id_col, text_col, width, percent)
    kept = groups.where(F.col("doc").eqNullSafe(F.col("component")) & (F.col("n") > 0)).select(F.col("doc").alias("__doc"), F.col("sig").alias("__kept")).distinct()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 256):
                sig = [signature(gram_set(t, width)) for t in part.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sig, pa.binary())], names=[*part.schema.names, "__sig"])

    if {"__doc", "__kept", "__sig"} & {*docs.columns}:
        raise ValueError("the columns __doc, __kept and __sig are taken")
    own = [F.col(f"`{c}`") for c in docs.columns]
    signed = docs.mapInArrow(sign, T.StructType([*docs.schema.fields, T.StructField("__sig", T.BinaryType())]))
    there = F.col(f"`{id_col}`").eqNullSafe(F.col("__doc")) & (F.col("__sig") == F.col("__kept"))
    one = signed.where("__sig is not null").join(kept, there, "left_semi").dropDuplicates([id_col, "__sig"]).select(*own)
    return one.union(signed.where("__sig is null").select(*own))
