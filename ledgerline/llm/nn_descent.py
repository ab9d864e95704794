"""Approximate nearest neighbours: NN-descent builds a neighbour graph, queries search it greedily.

Nearness is the inner product.  Equal vectors are one node that knows its
smallest ids.

Building.  Random hyperplanes cut the nodes into leaves a few times over; the
best within the leaves start every node's list, and so do the best of a group
dealt by chance, which is never small: a node alone in its leaves has a full
list, too.  Then, round by round, each
node introduces its neighbours (those in its list and those that list it) to
each other, if one of the two is new to it: neighbours of neighbours.  Pairs
that beat the end of a list go into it, until few entries change.  All rounds
are joins: lists and vectors meet by node, and vectors travel in 16 bits per
component (8 mix up the order within tight clusters).

Searching.  A query starts at its own node's list and at entry nodes that all
share, expands the nearest nodes not yet expanded, scores their neighbours
(both ways) on the original vectors in double precision, and goes on until its
nearest ``k`` and its own node are expanded.  State is a row per query.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, slices

#: List length; reverse neighbours that take part in a round; leaves cut; nodes in a leaf.
NEIGHBOURS, REVERSE, TREES, LEAF = 40, 40, 3, 256
#: Reverse neighbours that take part besides the nearest, drawn by chance: those far from all others.
CHANCE = 10
#: Rounds at most, and the share of list entries below which another round is not worth it.
ROUNDS, ENOUGH = 10, 0.01
#: Best partners that a node is told of by one introduction.
TOLD = 4
#: Nodes expanded at once by a query, nodes it keeps, and entry nodes.
EXPAND, BEAM, ENTRIES = 8, 64, 64


def quantized(v: np.ndarray) -> list[bytes]:
    """Each row as a scale (float32) and 16-bit components."""
    scale = np.maximum(np.abs(v).max(axis=1, initial=0), 1e-30).astype(np.float32) / 32767
    q = np.rint(v / scale[:, None]).astype(np.int16)
    return [s.tobytes() + x.tobytes() for s, x in zip(scale, q)]


def expanded(data: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(data), np.uint8).reshape(len(data), -1)
    return raw[:, 4:].view(np.int16).astype(np.float32) * raw[:, :4].copy().view(np.float32)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values) if values else [], kind))


GRAPH = "node bigint, ids array<bigint>, s array<float>, fresh array<boolean>"


def _nodes(vectors: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """``node, ids, v``: the different usable vectors, each with its ``k + 1`` smallest ids."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    usable = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).where("id is not null and v is not null")
    usable = usable.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    rank = F.row_number().over(W.partitionBy("v").orderBy("id"))
    few = usable.withColumn("r", rank).where(F.col("r") <= k + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.monotonically_increasing_id().alias("node"), "ids", "v")


def _leaves(nodes: DataFrame, count: int, dim: int, tree: int, neighbours: int, by_chance: bool = False) -> DataFrame:
    """``node, other, s``: the best of each node within its leaf; large leaves are dealt out by chance, as are all nodes without planes."""
    bits = 0 if by_chance else max(0, int(np.ceil(np.log2(max(1, count / LEAF)))))
    most = LEAF if by_chance else 4 * LEAF
    planes = np.random.default_rng(1000 + tree).standard_normal((dim, bits)).astype(np.float32)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = expanded(batch.column(1).to_pylist()) if batch.num_rows else np.empty((0, dim), np.float32)
            code = (x @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code.astype(np.int64))], names=["node", "q", "leaf"])

    coded = nodes.select("node", "q").mapInArrow(cut, "node bigint, q binary, leaf bigint")
    sizes = coded.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / most).alias("parts"))
    dealt = coded.join(sizes, "leaf").withColumn("part", F.pmod(F.xxhash64("node", F.lit(tree)), "parts"))

    def best(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        x = expanded(table.column("q").to_pylist())
        s = x @ x.T
        np.fill_diagonal(s, -np.inf)
        k = min(neighbours, len(node) - 1)
        top = np.argpartition(-s, k - 1, axis=1)[:, :k] if 0 < k < len(node) else np.empty((len(node), 0), np.int64)
        return pa.table({"node": np.repeat(node, k), "other": node[top].reshape(-1), "s": np.take_along_axis(s, top, 1).reshape(-1).astype(np.float32)})

    return dealt.select("leaf", "part", "node", "q").groupBy("leaf", "part").applyInArrow(best, "node bigint, other bigint, s float")


def _merged(graph: DataFrame | None, news: DataFrame, neighbours: int) -> DataFrame:
    """Lists with news (``node, other, s``) merged in: the best ``neighbours`` of each node; what came in is fresh."""
    told = news.groupBy("node").agg(F.collect_list(F.struct("other", "s")).alias("told"))
    if graph is None:
        both = told.select("node", F.array().cast("array<bigint>").alias("ids"), F.array().cast("array<float>").alias("s"), F.array().cast("array<boolean>").alias("fresh"), "told")
    else:
        both = graph.join(told, "node", "left").select("node", "ids", "s", "fresh", "told")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 512):
                out_ids, out_s, out_fresh = [], [], []
                cols = [part.column(i) for i in range(1, 5)]
                flat = [(c.offsets.to_numpy(), c.values) for c in cols]
                ids, s = flat[0][1].to_numpy(zero_copy_only=False), flat[1][1].to_numpy(zero_copy_only=False)
                told_ids, told_s = (flat[3][1].field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                for i in range(part.num_rows):
                    a, b = flat[0][0][i], flat[0][0][i + 1]
                    c, d = flat[3][0][i], flat[3][0][i + 1]
                    all_ids, all_s = np.concatenate([ids[a:b], told_ids[c:d]]), np.concatenate([s[a:b], told_s[c:d]])
                    fresh = np.arange(len(all_ids)) >= b - a
                    _, first = np.unique(all_ids, return_index=True)  # an old entry stays old
                    top = first[np.lexsort((all_ids[first], -all_s[first]))][:neighbours]
                    out_ids.append(all_ids[top])
                    out_s.append(all_s[top])
                    out_fresh.append(fresh[top])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _lists(out_ids, pa.int64()), _lists(out_s, pa.float32()), _lists(out_fresh, pa.bool_())], names=["node", "ids", "s", "fresh"]
                )

    return both.mapInArrow(merge, GRAPH)


def _some_back(back: DataFrame, salt: int) -> DataFrame:
    """Of those that list a node ``at`` with score ``s``: the nearest, and some by chance."""
    near = F.row_number().over(W.partitionBy("at").orderBy(F.desc("s"), "node"))
    drawn = F.row_number().over(W.partitionBy("at").orderBy(F.xxhash64("node", F.lit(salt)), "node"))
    return back.withColumn("r", near).withColumn("c", drawn).where((F.col("r") <= REVERSE) | (F.col("c") <= CHANCE)).drop("r", "c")


def _introductions(graph: DataFrame, nodes: DataFrame, neighbours: int, salt: int) -> DataFrame:
    """``node, other, s``: pairs that meet at a common neighbour and beat the end of the node's list, or find it not full."""
    last = F.when(F.size("s") < neighbours, F.lit(float("-inf"))).otherwise(F.get("s", F.size("s") - 1)).cast("float")
    full = graph.join(nodes.select("node", "q"), "node").withColumn("last", last)
    # a node's own list: the neighbours' vectors are fetched by their ids
    pairs = full.select(F.col("node").alias("at"), F.explode(F.arrays_zip("ids", "fresh", "s")).alias("e")).select("at", F.col("e.ids").alias("node"), F.col("e.fresh").alias("fresh"))
    forward = pairs.join(full.select("node", "q", "last"), "node").select("at", "node", "fresh", "q", "last")
    # those that list it bring their own; the nearest take part, and some by chance
    back = full.select("node", "q", "last", F.explode(F.arrays_zip("ids", "fresh", "s")).alias("e")).select(F.col("e.ids").alias("at"), "node", F.col("e.fresh").alias("fresh"), "q", "last", F.col("e.s").alias("s"))
    back = _some_back(back, salt).drop("s")
    met = forward.union(back).groupBy("at").agg(F.collect_list(F.struct("node", "fresh", "q", "last")).alias("m")).where(F.exists("m", lambda x: x["fresh"]))

    def introduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 256):
                col, out = part.column(0), [[], [], []]
                offsets, rows = col.offsets.to_numpy(), col.values
                if not part.num_rows:
                    continue
                node, last = rows.field(0).to_numpy(zero_copy_only=False), rows.field(3).to_numpy(zero_copy_only=False)
                fresh = rows.field(1).to_numpy(zero_copy_only=False)
                q = rows.field(2)
                x = expanded(q.to_pylist())
                for a, b in zip(offsets[:-1], offsets[1:]):
                    a, b = int(a), int(b)
                    _, keep = np.unique(node[a:b], return_index=True)
                    new = np.zeros(b - a, bool)
                    np.logical_or.at(new, np.searchsorted(node[a:b][keep], node[a:b]), fresh[a:b])
                    n, y, end, new = node[a:b][keep], x[a:b][keep], last[a:b][keep], new[: len(keep)]
                    s = y @ y.T
                    s[~(new[:, None] | new[None, :])] = -np.inf
                    np.fill_diagonal(s, -np.inf)
                    s[s <= end[:, None]] = -np.inf  # a list that is not full ends at -inf
                    k = min(TOLD, len(n))
                    top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                    best = np.take_along_axis(s, top, 1)
                    i, j = np.nonzero(best > -np.inf)
                    out[0].append(n[i])
                    out[1].append(n[top[i, j]])
                    out[2].append(best[i, j])
                cols = [np.concatenate(c) if c else np.empty(0) for c in out]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)), pa.array(cols[2].astype(np.float32))], names=["node", "other", "s"])

    return met.select("m").mapInArrow(introduce, "node bigint, other bigint, s float").groupBy("node", "other").agg(F.max("s").alias("s"))


def _collect_garbage(df: DataFrame) -> None:
    """Let Spark drop the shuffle files of rounds that nothing refers to any more."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def neighbour_graph(nodes: DataFrame, scratch: Scratch, neighbours: int = NEIGHBOURS, trees: int = TREES, rounds: int = ROUNDS) -> DataFrame:
    """``node, ids, s, fresh`` for ``nodes`` (``node, q, dim``): each node's best neighbours found, best first."""
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("d")).first()
    count, dim = size["n"], size["d"] or 1
    news = None
    for tree in range(trees + 1):
        leaf = _leaves(nodes, count, dim, tree, neighbours, tree == trees)
        news = leaf if news is None else news.union(leaf)
    every = nodes.select("node", F.lit(None).cast("bigint").alias("other"), F.lit(None).cast("float").alias("s"))
    lists = _merged(None, news.groupBy("node", "other").agg(F.max("s").alias("s")), neighbours)
    alone = every.join(lists, "node", "left_anti").selectExpr("node", "cast(array() as array<bigint>) as ids", "cast(array() as array<float>) as s", "cast(array() as array<boolean>) as fresh")
    graph, path = scratch.write(lists.union(alone))
    for turn in range(rounds):
        news, told = scratch.write(_introductions(graph, nodes, neighbours, turn))
        old = path
        graph, path = scratch.write(_merged(graph, news, neighbours))
        changed = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0] or 0
        scratch.release(old)
        scratch.release(told)
        del news
        _collect_garbage(nodes)
        if changed <= ENOUGH * count * neighbours:
            break
    return graph


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, scratch: Scratch, k: int) -> DataFrame:
    """``query, node, score``: for each query (``query, node, v``) at least ``k`` nearest nodes found, its own node included."""
    beam = max(BEAM, 2 * k)
    state_type = "query bigint, v array<double>, ids array<bigint>, s array<double>, done array<boolean>"
    state = queries.select("query", "v", F.array("node").alias("ids"), F.array(F.lit(float("inf"))).alias("s"), F.array(F.lit(False)).alias("done"))
    state, path = scratch.write(state)
    listed = graph.select("node", F.explode(F.arrays_zip("ids", "s")).alias("e")).select(F.col("e.ids").alias("at"), "node", F.col("e.s").alias("s"))
    back = _some_back(listed, -1).groupBy(F.col("at").alias("node")).agg(F.collect_list("node").alias("back"))
    both = F.array_union("ids", F.coalesce("back", F.array().cast("array<bigint>")))
    graph, _ = scratch.write(graph.join(back, "node", "left").select("node", both.alias("near")))
    entries = [r["node"] for r in nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(ENTRIES).collect()]
    first = True
    while True:
        # ids are best first; the nearest unexpanded ones go on
        open_ids = F.slice(F.filter(F.arrays_zip("ids", "done"), lambda x: ~x["done"]), 1, EXPAND)
        todo = state.select("query", "ids", F.transform(open_ids, lambda x: x["ids"]).alias("go"))
        met = todo.select("query", "ids", F.explode("go").alias("node")).join(graph, "node")
        fresh = met.select("query", F.explode(F.array_except("near", "ids")).alias("node"))
        if first and entries:
            shared = F.array(*map(F.lit, entries)).cast("array<bigint>")
            fresh = fresh.union(state.select("query", F.explode(F.array_except(shared, F.col("ids"))).alias("node")))
        fresh, first = fresh.distinct(), False
        scored = fresh.join(nodes.select("node", F.col("v").alias("w")), "node")
        found = scored.groupBy("query").agg(F.collect_list(F.struct("node", "w")).alias("found"))
        rows = state.join(todo.select("query", "go"), "query").join(found, "query", "left").select("query", "v", "ids", "s", "done", "go", "found")

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, 64):
                    ids_out, s_out, done_out = [], [], []
                    vs, ids, ss, dones, gos, founds = (part.column(i) for i in range(1, 7))
                    for i in range(part.num_rows):
                        v = np.array(vs[i].as_py())
                        a, s, done = np.array(ids[i].as_py(), np.int64), np.array(ss[i].as_py()), np.array(dones[i].as_py(), bool)
                        done |= np.isin(a, np.array(gos[i].as_py() or [], np.int64))
                        f = founds[i]
                        if f.is_valid and len(f.values):
                            w = f.values.field(1)
                            x = w.flatten().to_numpy(zero_copy_only=False).reshape(len(w), -1)
                            a = np.concatenate([a, f.values.field(0).to_numpy(zero_copy_only=False)])
                            s = np.concatenate([s, (x * v).sum(axis=1)])
                            done = np.concatenate([done, np.zeros(len(w), bool)])
                        top = np.lexsort((a, -s))[:beam]
                        ids_out.append(a[top])
                        s_out.append(s[top])
                        done_out.append(done[top])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), vs, _lists(ids_out, pa.int64()), _lists(s_out, pa.float64()), _lists(done_out, pa.bool_())], names=["query", "v", "ids", "s", "done"]
                    )

        old = path
        state, path = scratch.write(rows.mapInArrow(step, state_type))
        scratch.release(old)
        # a query is through when its nearest k are all expanded
        if not state.where(F.exists(F.slice("done", 1, k + 1), lambda x: ~x)).limit(1).count():
            break
    own = state.select("query", F.explode(F.arrays_zip("ids", "s")).alias("e"))
    return own.select("query", F.col("e.ids").alias("node"), F.col("e.s").alias("score"))


def nearest(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``queries`` holds for, the ``k`` nearest other rows found.

    Score is the inner product of the original vectors in double precision;
    ties go to the smaller id.  Vectors that are null, zero, or hold null or
    non-finite components take no part, nor do rows without id or whose
    length differs from the longest.  Rows that repeat an id and its vector
    are one query, and candidates of each other's; an id with several vectors is
    a query with each, and its other rows are candidates.  Where there are fewer
    than ``k`` others, all are returned.  An empty table gives an empty result.
    """
    scratch = Scratch(vectors.sparkSession, "nn")
    nodes = _nodes(vectors, id_col, vec_col, k)
    nodes, _ = scratch.write(nodes)
    dim = nodes.agg(F.max(F.size("v"))).first()[0] or 1
    nodes = nodes.where(F.size("v") == dim)

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(2)
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) if batch.num_rows else np.empty((0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(quantized(x), pa.binary()), pa.array([dim] * batch.num_rows, pa.int32())], names=["node", "ids", "v", "q", "dim"])

    nodes, _ = scratch.write(nodes.mapInArrow(shrink, "node bigint, ids array<bigint>, v array<double>, q binary, dim int"))
    graph = neighbour_graph(nodes.select("node", "q", "dim"), scratch)
    rows = vectors.where(queries).select(F.col(f"`{id_col}`").cast("bigint").alias("query"), F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double")).alias("v")).distinct()
    # a query is an id with one of its vectors: its number tells those of one id apart
    rows = rows.join(nodes.select("node", "v"), "v").select(F.xxhash64("query", "node").alias("row"), "query", "node", "v")
    found = search(rows.select(F.col("row").alias("query"), "node", "v"), nodes.select("node", "v"), graph, scratch, k).withColumnRenamed("query", "row")
    # the query's own node holds the rows with an equal vector
    norm = rows.select("row", "query", F.col("node").alias("own"), F.aggregate(F.transform("v", lambda x: x * x), F.lit(0.0), lambda acc, x: acc + x).alias("norm"))
    scored = found.join(norm, "row").withColumn("score", F.when(F.col("node") == F.col("own"), F.col("norm")).otherwise(F.col("score")))
    # of the own node's rows the query's own is left out once
    self_at = F.array_position("ids", F.col("query"))
    each = scored.join(nodes.select("node", "ids"), "node").withColumn("self", F.when(F.col("node") == F.col("own"), self_at).otherwise(F.lit(0)))
    each = each.select("row", "query", "score", "self", F.posexplode("ids").alias("i", "vec_id")).where("i + 1 <> self")
    rank = F.row_number().over(W.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
