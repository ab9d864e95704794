"""Splittable scan of multi-line JSON documents: one array of objects, or one object, per file.

Spark's multi-line reader gives a whole document to one task.  Here the text
reader cuts files at closing braces instead of line ends, so a document of any
size and layout (pretty-printed, or one endless line) is read in splits.

What a brace means depends on all text before it.  So each split first yields
its *transition function*: for both ways it may start (inside a string or not),
whether it ends in one, how far the depth changes, and the least depth at any
of its closing braces.  Composing the functions of a file's splits in order --
running sums over a row per split -- gives the state at the start of each
split.  With it every split finds the records in it.  Records that lie in one
split are emitted where they are; only the pieces at the borders of splits are
shuffled, and put together by the record they belong to.

An escape never spans a split: in JSON no backslash stands before a brace.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.layout import materialized

#: Splits whose states are broadcast (under 100 bytes each); beyond, they are joined by a shuffle.
MAX_BROADCAST_SPLITS = 1 << 20

# the scan's functions travel with their tasks: executors need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_QUOTE, _BACKSLASH = ord('"'), ord("\\")
_DEPTH = np.zeros(256, np.int8)
_DEPTH[[ord("{"), ord("[")]] = 1
_DEPTH[[ord("}"), ord("]")]] = -1
_BLANK = b" \t\r\n"
_BOM = b"\xef\xbb\xbf"
_NEVER = 1 << 60

Schema = T.StructType | str


def _segments(spark: SparkSession, path: str | list[str], options: dict | None) -> DataFrame:
    """Text between closing braces: ``value, file, start, size, whole`` in the order of each
    split; ``whole``: the split is a file of its own."""
    reader = spark.read.option("lineSep", "}")
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    at = F.col("_metadata")
    return reader.schema("value string").text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.xxhash64(at["file_path"]).alias("file"),
        at["file_block_start"].alias("start"),
        at["file_size"].alias("size"),
        ((at["file_block_start"] == 0) & (at["file_block_length"] >= at["file_size"])).alias("whole"),
    )


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary array, and where each value starts and ends in them."""
    kind = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    _, places, data = values.buffers()
    ends = np.frombuffer(places, kind)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def _structure(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Brackets and segment ends in order: (step of the depth, odd number of quotes before,
    index of those that are segment ends, odd number of quotes in all)."""
    quotes = np.flatnonzero(data == _QUOTE)
    behind = quotes[quotes > 0]
    if len(behind) and (data[behind - 1] == _BACKSLASH).any():
        place = np.arange(len(data))
        last = np.maximum.accumulate(np.where(data == _BACKSLASH, -1, place))  # last other byte
        first = np.concatenate([[0], ends])[np.searchsorted(ends, quotes, "right")]  # a segment starts afresh
        run = np.where(quotes > 0, quotes - 1 - np.maximum(last[np.maximum(quotes - 1, 0)], first - 1), 0)
        quotes = quotes[run % 2 == 0]
    step = _DEPTH[data]
    brackets = np.flatnonzero(step)
    closing = ends[1:]
    order = np.argsort(np.concatenate([2 * brackets, 2 * closing - 1]), kind="stable")
    steps = np.concatenate([step[brackets], np.full(len(closing), -1, np.int8)])[order].astype(np.int64)
    odd = np.concatenate([np.searchsorted(quotes, brackets), np.searchsorted(quotes, closing)])[order] & 1
    return steps, odd.astype(bool), np.flatnonzero(order >= len(brackets)), len(quotes) & 1


def _runs(batch: pa.RecordBatch, cols: tuple[int, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows that agree in the key columns, with their key."""
    keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in cols]
    cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
    for a, b in zip([0, *cut], [*cut, batch.num_rows]):
        if b > a:
            yield tuple(int(k[a]) for k in keys), batch.slice(a, b - a)


_FUNCTION = "file bigint, start bigint, size bigint, flips int, d0 bigint, d1 bigint, low0 bigint, low1 bigint, bytes bigint, head int"


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The transition function of every split of a task, streamed."""
    key, state = None, None

    def row() -> pa.RecordBatch:
        fields = [*key, state["flips"], *state["depth"], *state["low"], state["bytes"], state["head"]]
        names = [f.split()[0] for f in _FUNCTION.split(", ")]
        kinds = [pa.int32() if f.endswith(" int") else pa.int64() for f in _FUNCTION.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(fields, kinds)], names=names)

    for batch in batches:
        for at, part in _runs(batch, (1, 2, 3)):
            if at != key:
                if key is not None:
                    yield row()
                key, state = at, {"flips": 0, "depth": [0, 0], "low": [_NEVER, _NEVER], "bytes": 0, "head": -1}
            data, ends = _bytes(part.column(0))
            steps, odd, closing, flips = _structure(data, ends)
            depth, low = list(state["depth"]), list(state["low"])
            for s in (0, 1):  # the state the split starts in
                outside = odd == bool(s ^ state["flips"])
                reached = depth[s] + np.cumsum(np.where(outside, steps, 0))
                at_end = reached[closing][outside[closing]]
                low[s] = min(low[s], int(at_end.min())) if len(at_end) else low[s]
                depth[s] = int(reached[-1]) if len(reached) else depth[s]
            state.update(depth=depth, low=low, flips=state["flips"] ^ flips, bytes=state["bytes"] + len(data) + part.num_rows)
            if state["head"] < 0:
                state["head"] = _head(data)
    if key is not None:
        yield row()


def _head(data: np.ndarray) -> int:
    """The first byte that is not blank, behind a byte-order mark; -1 without one."""
    solid = data[:4096].tobytes().removeprefix(_BOM).lstrip(_BLANK) or data.tobytes().removeprefix(_BOM).lstrip(_BLANK)
    return solid[0] if solid else -1


def _states(functions: DataFrame) -> DataFrame:
    """The composed state at the start of each split: a window over the splits of one file."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    known = functions.withColumn("inside", F.coalesce(F.sum("flips").over(before), zero) % 2 == 1)
    known = known.withColumns({
        "depth": F.coalesce(F.sum(F.when(F.col("inside"), F.col("d1")).otherwise(F.col("d0"))).over(before), zero),
        # records are the objects of the array, or the one object of the file
        "base": F.when(F.first(F.when(F.col("head") >= 0, F.col("head")), ignorenulls=True).over(file) == ord("["), 1).otherwise(0),
        "last": F.col("start") == F.max("start").over(file),
        "total": F.sum("bytes").over(file),
    })
    low = F.when(F.col("inside"), F.col("low1")).otherwise(F.col("low0"))
    known = known.withColumn("ends", F.col("depth") + low <= F.col("base"))
    return known.select(
        "file", "start", "inside", "depth", "base", "last", "ends",
        # the split that the first record here began in: the last one ahead in which a record ended
        F.coalesce(F.last(F.when(F.col("ends"), F.col("start")), ignorenulls=True).over(before), F.lit(-1)).alias("owner"),
        # whether the file's last segment had its brace
        F.when(F.col("total") == F.col("size"), 1).when(F.col("total") == F.col("size") + 1, 0).otherwise(-1).alias("closed"),
    )


_PIECE = "value binary, file bigint, owner bigint, start bigint, base int, final boolean"


class _Split:
    """Follows the state of one split as its segments stream by."""

    def __init__(self, file, start, size, inside, depth, base, last, owner, closed):
        self.file, self.start, self.size, self.base = file, start, size, base
        self.whole = base < 0  # the split is a file of its own: its state is known
        self.last, self.closed = bool(last), closed
        self.inside, self.depth, self.owner = bool(inside), depth, owner
        self.bytes = 0
        self.ended = self.whole  # whether a record has ended in this split (or none began ahead of it)
        self.fresh = self.whole  # whether the start of the file is still ahead
        self.open: list[bytes] = []  # text of the record that is open, braces included

    def ends(self, part: pa.RecordBatch, is_end: bool) -> tuple[bytes, np.ndarray, np.ndarray, int]:
        """The bytes of ``part``, where its segments lie in them, the segments that end a record,
        and the number of those that a brace follows; ``is_end``: no more segments come."""
        data, at = _bytes(part.column(0))
        if self.base < 0:
            self.base = int(_head(data) == ord("["))
        self.bytes += len(data) + part.num_rows
        steps, odd, closing, flips = _structure(data, at)
        outside = odd == self.inside
        reached = self.depth + np.cumsum(np.where(outside, steps, 0))
        done, n = outside[closing] & (reached[closing] <= self.base), part.num_rows
        if is_end and self.last and not self._has_brace(data[at[n - 1] :].tobytes()):
            n -= 1  # the file's rest
        self.inside ^= bool(flips)
        self.depth = int(reached[-1]) if len(reached) else self.depth
        return data.tobytes(), at, np.flatnonzero(done[:n]), n

    def _has_brace(self, rest: bytes) -> bool:
        """Whether the file's last segment had its brace, as told by the bytes of an uncompressed file."""
        closed = self.closed
        if self.whole:
            closed = {self.size: 1, self.size + 1: 0}.get(self.bytes, -1)
        return bool(closed) if closed >= 0 else bool(rest.strip(_BLANK + b",]"))

    def started(self, text: bytes) -> bytes:
        """``text`` without what a file starts with, if it is a file's first one."""
        if self.fresh:
            self.fresh, text = False, text.removeprefix(_BOM).lstrip(_BLANK)
            return text[1:] if self.base and text.startswith(b"[") else text
        return text


def _text(raw: bytes, at: np.ndarray, a: int, b: int) -> bytes:
    """Segments ``a`` to ``b`` (not included), with their braces."""
    return b"".join(raw[at[k] : at[k + 1]] + b"}" for k in range(a, b))


def _inner(split: _Split, part: pa.RecordBatch, is_end: bool) -> tuple[pa.Array, list[bytes]]:
    """Records that begin and end in the split, without their last brace, and malformed text.

    The first record of a split that is no whole file may have begun ahead of
    it, and is left to :func:`_border`, as is the text behind the last one.
    """
    raw, at, ends, n = split.ends(part, is_end)
    long, bad, short = [], [], part.column(0).slice(0, 0)
    if len(ends):
        if split.ended:
            text = b"".join([*split.open, _text(raw, at, 0, int(ends[0]))]) + raw[at[ends[0]] : at[ends[0] + 1]]
            long.append(split.started(text))
        first, last = ends[:-1] + 1, ends[1:]
        for a, b in zip(first[first != last], last[first != last]):
            long.append(_text(raw, at, a, b) + raw[at[b] : at[b + 1]])
        short = part.column(0).take(pa.array(last[first == last]))  # a record of one segment, as it stands
        split.ended, split.open = True, [_text(raw, at, int(ends[-1]) + 1, n)]
    elif split.ended and n:
        split.open.append(_text(raw, at, 0, n))
    if is_end and split.whole:
        rest = split.started(b"".join(split.open) + raw[at[n] :]).strip(_BLANK + b",")
        if rest != (b"]" if split.base else b""):
            bad.append(rest or b"[")  # an array cut off behind a record leaves no text: its open bracket stands for it
    return pa.concat_arrays([short.cast(pa.binary()), pa.array(long, pa.binary())]), bad


def _border(split: _Split, part: pa.RecordBatch, is_end: bool) -> Iterator[tuple]:
    """Pieces at the split's borders: the text up to its first end of a record (the text behind the last one follows)."""
    raw, at, ends, n = split.ends(part, is_end)
    if len(ends) and not split.ended:
        yield b"".join([*split.open, _text(raw, at, 0, int(ends[0]) + 1)]), split.file, split.owner, split.start, split.base, False
        split.ended, split.owner = True, split.start
    if len(ends):
        split.open = []
    split.open.append(_text(raw, at, int(ends[-1]) + 1 if len(ends) else 0, n) + raw[at[n] :])


def _last_piece(split: _Split) -> Iterator[tuple]:
    text = b"".join(split.open)
    if text or split.last:
        yield text, split.file, split.owner, split.start, split.base, split.last


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Split, pa.RecordBatch, bool]]:
    """Stretches of segments with their split, each told whether it is the split's last one."""
    key, split, held = None, None, None
    for batch in batches:
        for now, part in _runs(batch, tuple(range(1, 10))):
            if split is not None:
                yield split, held, now != key
            if now != key:
                key, split = now, _Split(*now)
            held = part
    if split is not None:
        yield split, held, True


def _inner_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for split, part, is_end in _followed(batches):
        found, bad = _inner(split, part, is_end)
        for values, brace in ((found, True), (pa.array(bad, pa.binary()), False)):
            if len(values):
                yield pa.RecordBatch.from_arrays([values, pa.array(np.full(len(values), brace))], names=["value", "brace"])


def _border_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"binary": pa.binary(), "boolean": pa.bool_(), "bigint": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in _PIECE.split(", ")]
    for split, part, is_end in _followed(batches):
        rows = [*_border(split, part, is_end), *(_last_piece(split) if is_end else ())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def json_records(spark: SparkSession, path: str | list[str], options: dict | None = None, max_broadcast_splits: int = MAX_BROADCAST_SPLITS) -> DataFrame:
    """The text of every record (``value``) of JSON documents, read in splits.

    A document is an array of objects or one object.  Text that is no object
    where one should stand (a bare element, the rest of a file cut off) comes
    as a record, too, which no JSON parser accepts; nothing is dropped but
    white space, commas and the array's brackets.  Several objects after one
    another are a record each.  Blank files have none.  Files must be UTF-8;
    compressed ones are read by one task each.

    The text is scanned for the functions of splits and for the records inside
    them, and if there are files of several splits, for the pieces at their
    borders: reading again is cheaper than keeping all records to find those few.
    """
    segments = _segments(spark, path, options)
    cut = segments.where(~F.col("whole")).drop("whole")
    states = materialized(_states(cut.mapInArrow(_functions, _FUNCTION)), "json_states")
    splits = states.count()
    own = {"inside": 0, "depth": 0, "base": -1, "last": 1, "owner": -1, "closed": -1}
    kinds = {c: "bigint" if c in ("depth", "owner") else "int" for c in own}
    columns = ["value", "file", "start", "size", *own]
    filled = [F.coalesce(F.col(c).cast(kinds[c]), F.lit(own[c]).cast(kinds[c])).alias(c) if c in own else F.col(c) for c in columns]
    if not splits:
        placed = segments.select(*columns[:4], *[F.lit(v).cast(kinds[c]).alias(c) for c, v in own.items()])
    elif splits <= max_broadcast_splits:  # a file of its own has no row in states
        placed = segments.join(F.broadcast(states), ["file", "start"], "left").select(*filled)
    else:  # segments travel to their split's state and are put in order again
        ordered = segments.withColumn("at", F.monotonically_increasing_id()).join(states, ["file", "start"], "left")
        placed = ordered.repartition("file", "start").sortWithinPartitions("file", "start", "at").select(*filled)
    lead, text = F.lit(" \t\r\n,"), F.col("value").cast("string")
    brace = F.when(F.col("brace"), F.lit("}")).otherwise(F.lit(""))
    inner = placed.mapInArrow(_inner_records, "value binary, brace boolean").select(F.concat(F.ltrim(text, lead), brace).alias("value"))
    if not splits:
        return inner
    pieces = placed.where("base >= 0").mapInArrow(_border_pieces, _PIECE).groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("start", text.alias("text")))).alias("p"),
        F.first("base").alias("base"), F.max("final").alias("final"))
    joined = pieces.select(F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"), "owner", "base", "final")
    opened = F.when(F.col("owner") == -1, F.when(F.col("base") == 1, F.regexp_replace("text", r"^\x{FEFF}?\s*\[", "")).otherwise(F.regexp_replace("text", r"^\x{FEFF}", "")))
    clean = joined.select(F.ltrim(F.coalesce(opened, "text"), lead).alias("value"), "base", "final")
    # a file ends in the array's bracket, or in nothing
    end = F.when(F.col("base") == 1, F.lit("]")).otherwise(F.lit(""))
    across = clean.where(~F.col("final") | (F.rtrim(F.col("value"), F.lit(" \t\r\n")) != end))
    # an array cut off behind a record leaves no text: its open bracket stands for it
    across = across.select(F.when(F.col("value") == "", "[").otherwise(F.col("value")).alias("value"))
    return inner.unionByName(across)


def read_json_array(spark: SparkSession, path: str | list[str], schema: Schema, options: dict | None = None, json_options: dict | None = None) -> DataFrame:
    """Rows of JSON documents with ``schema``, as ``spark.read.json(multiLine)`` gives them, read in splits.

    A record that is not valid JSON is one row of nulls (with its text in the
    column that ``columnNameOfCorruptRecord`` in ``json_options`` names, if the
    schema has it), where the one-task reader gives up the whole document.
    ``options`` go to the file scan, ``json_options`` to the parser
    (``from_json``: modes PERMISSIVE and FAILFAST).
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # a generator of one row: each record is parsed once, however many fields and filters read it
    return json_records(spark, path, options).select(F.inline(F.array(F.from_json("value", kind, json_options or {}))))
