"""Vector code compression: product codes trained by member-resident Lloyd rounds.

Components become whole numbers, ``floor(scale * x)``, so every distance and
sum is exact and no result depends on how rows are partitioned.  A vector is
cut into equal parts, one codebook for each position.

The members of an entry stay with their owner: a table of parts, bucketed by
(position, entry, salt).  In each round the parts of a bucket find their
nearest entry where they are.  Those that keep their entry are written back to
their bucket without an exchange; only parts that change entry are shuffled, to
the buckets of their new owner.  Owners then update from resident members: the
sums of a (position, entry, salt) need no exchange either, and one row for
each of them is added up to new entries.  Salts are dealt by a hash of the
part, so an entry that holds most parts has many owners, and equal parts of
one batch are one member that knows how many they are.

Codebooks have ``positions * entries`` rows, whatever the input, and travel as
a broadcast; the final codes are one narrow pass over the vectors.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, release, staged
from ledgerline.operators.joins import skew_join

POSITIONS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Parts that one bucket of members holds, about.
BUCKET_PARTS = 1 << 19
#: Whole components stay within this bound, so that distances of parts fit 64 bits.
LIMIT = 1 << 26
OWNER = ["position", "entry", "salt"]

#: For each position, its entries as an array of whole numbers (entries, width).
Codebooks = list[np.ndarray]


def whole_vectors(vectors: DataFrame, vector_col: str, name: str = "whole", scale: int = SCALE) -> DataFrame:
    """``vectors`` whose vector is neither null nor empty nor holds null, NaN or infinite
    components, with the vector as whole numbers in column ``name``.  Components past the limit are an error."""
    v = F.col(f"`{vector_col}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    scaled = lambda x: F.floor(x.cast("double") * float(scale))
    bounded = F.forall(v, lambda x: F.abs(scaled(x)) <= LIMIT)
    whole = F.when(bounded, F.transform(v, lambda x: scaled(x).cast("int"))).otherwise(F.raise_error(F.lit(f"components beyond {LIMIT // scale} in size")).cast("array<int>"))
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & finite).withColumn(name, whole)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """An array column as a matrix of 64-bit whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) != len(column) * width:
        raise ValueError(f"vectors differ in length from {width}")
    return flat.reshape(len(column), width)


def assigned(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part (ties: the first) and its squared distance, exactly."""
    best = np.zeros(len(parts), np.int64)
    least = np.full(len(parts), np.iinfo(np.int64).max)
    for e, entry in enumerate(book):
        away = parts - entry
        d = np.einsum("ij,ij->i", away, away)
        nearer = d < least
        best[nearer], least[nearer] = e, d[nearer]
    return best, least


def _lists(m: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel().astype(np.int32)))


def _first_members(whole: DataFrame, books: Codebooks, width: int, salts: int) -> DataFrame:
    """A member for each distinct part of a batch: ``position, entry, salt, times, part``."""
    shared = whole.sparkSession.sparkContext.broadcast(books)
    names = [*OWNER, "times", "part"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column(0), width * len(shared.value))
            for p, book in enumerate(shared.value):
                parts, times = np.unique(m[:, p * width : (p + 1) * width], axis=0, return_counts=True)
                salt = (parts.astype(np.uint64) * _odd(width)).sum(axis=1, dtype=np.uint64) >> np.uint64(33)
                cols = [np.full(len(parts), p), assigned(parts, book)[0], (salt % np.uint64(salts)).astype(np.int64)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols), pa.array(times, pa.int64()), _lists(parts)], names=names)

    return whole.select("whole").mapInArrow(cut, "position int, entry int, salt int, times bigint, part array<int>")


def _odd(width: int) -> np.ndarray:
    """Odd multipliers that spread parts over salts."""
    return (np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _reassigned(members: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """``members`` and the entry ``goal`` that is nearest now."""
    shared = members.sparkSession.sparkContext.broadcast(books)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position = batch.column(0).to_numpy(zero_copy_only=False)
            m, goal = _matrix(batch.column(4), width), np.zeros(batch.num_rows, np.int32)
            for p in np.unique(position):
                at = np.flatnonzero(position == p)
                goal[at] = assigned(m[at], shared.value[p])[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(goal)], names=[*OWNER, "times", "part", "goal"])

    return members.select(*OWNER, "times", "part").mapInArrow(step, "position int, entry int, salt int, times bigint, part array<int>, goal int")


class Members:
    """The members of all entries, as a bucketed table that is replaced round by round."""

    def __init__(self, scratch: Scratch, buckets: int):
        self.spark, self.scratch, self.buckets, self.table, self.path = scratch.spark, scratch, buckets, None, None

    def replace(self, resident: DataFrame | None, movers: DataFrame) -> None:
        """``resident`` rows are written where they are; ``movers`` are dealt to their owner's bucket."""
        rows = movers.repartition(self.buckets, *OWNER)
        rows = rows if resident is None else resident.unionByName(rows)
        table, path = f"members_{uuid.uuid4().hex}", f"{self.scratch.base}/members_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, *OWNER).option("path", path).saveAsTable(table)
        self.drop()
        self.table, self.path = table, path

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def drop(self) -> None:
        if self.table:
            self.spark.sql(f"DROP TABLE {self.table}")
            release(self.spark, self.path)
            self.table = None

    def moved(self, books: Codebooks, width: int) -> tuple[DataFrame, DataFrame]:
        """Members that stay with their entry, and those that leave it, under its new name."""
        now = _reassigned(self.read(), books, width)
        stay = now.where("goal = entry").drop("goal")
        leave = now.where("goal <> entry").withColumn("entry", F.col("goal")).drop("goal")
        return stay, leave

    def sums(self, width: int) -> DataFrame:
        """``position, entry, n`` and the sums of the components; a bucket adds up its owners without an exchange."""
        parts = [F.sum(F.get("part", F.lit(j)).cast("bigint") * F.col("times")).alias(f"s{j}") for j in range(width)]
        owned = self.read().groupBy(*OWNER).agg(F.sum("times").alias("n"), *parts)
        return owned.groupBy("position", "entry").agg(*(F.sum(c).alias(c) for c in ["n", *(f"s{j}" for j in range(width))]))


def train_codebooks(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", positions: int = POSITIONS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, bucket_parts: int = BUCKET_PARTS) -> Codebooks:
    """Codebooks after ``rounds`` rounds of Lloyd's method over every part of every vector.

    They start from the rows of smallest ids (ties: smallest vector; null
    ids last), fewer if there are fewer rows.  An entry becomes the
    componentwise floor of its members' mean; one without members stays.
    Null, empty and non-finite vectors take no part; repeated rows
    count each time.  Vectors must agree in length, a multiple of
    ``positions``.  Without vectors there are no codebooks.
    """
    whole = whole_vectors(vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v")), "v", scale=scale).select("id", "whole")
    first = whole.orderBy(F.col("id").asc_nulls_last(), "whole").limit(entries).collect()
    if not first:
        return []
    width, rest = divmod(len(first[0]["whole"]), positions)
    if rest or not width:
        raise ValueError(f"vectors of {len(first[0]['whole'])} components cannot be cut into {positions} equal parts")
    start = np.array([r["whole"] for r in first], np.int64)
    books = [start[:, p * width : (p + 1) * width] for p in range(positions)]
    buckets = max(8, math.ceil(whole.count() * positions / bucket_parts))
    members = Members(Scratch(vectors.sparkSession, "vector_codes"), buckets)
    members.replace(None, _first_members(whole, books, width, salts=-(-buckets // positions)))
    for k in range(rounds):
        if k:
            members.replace(*members.moved(books, width))
        books = [b.copy() for b in books]
        for r in members.sums(width).collect():  # one row for each entry
            books[r["position"]][r["entry"]] = [r[f"s{j}"] // r["n"] for j in range(width)]
    members.drop()
    return books


def encode(vectors: DataFrame, books: Codebooks, vector_col: str = "embedding", scale: int = SCALE, code: str = "code", error: str = "error") -> DataFrame:
    """``vectors`` that take part, with two more columns: ``code``, the nearest entries in
    part order, two hex digits each, and ``error``, the summed squared distances."""
    if clash := {code, error} & set(vectors.columns):
        raise ValueError(f"columns are taken: {sorted(clash)}")
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    whole = whole_vectors(vectors, vector_col, error, scale)  # replaced below
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    names = [*vectors.columns, code, error]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            n, width = batch.num_rows, books[0].shape[1] if books else 0
            m = _matrix(batch.column(batch.num_columns - 1), width * len(books)) if books else None
            codes, errors = [], np.zeros(n, np.int64)
            for p, book in enumerate(books):
                best, away = assigned(m[:, p * width : (p + 1) * width], book)
                codes.append(best)
                errors += away
            text = ["".join(f"{c:02x}" for c in row) for row in zip(*(c.tolist() for c in codes))] if books else [""] * n
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(text, pa.string()), pa.array(errors)], names=names)

    return whole.mapInArrow(step, f"{fields}, `{code}` string, `{error}` bigint")


def codebooks_digest(books: Codebooks) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def same_label(label: Column) -> Column:
    """A label as text that tells null from any value."""
    return F.coalesce(F.concat(F.lit("="), label.cast("string")), F.lit(""))


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **options: int) -> DataFrame:
    """``id_col, code, error, label_error, codebooks_sha256`` of every vector that takes part.

    ``label_error`` is the error summed over equal labels, nulls together; a
    label that holds a large share of all rows is joined over several tasks.
    """
    books = train_codebooks(vectors, id_col, vector_col, **options)
    names = [F.col(f"`{c}`").alias(a) for c, a in ((id_col, "id"), (vector_col, "v"), (label_col, "label"))]
    coded = staged(encode(vectors.select(*names), books, "v").select("id", "code", "error", same_label(F.col("label")).alias("of")), "vector_codes")
    sums = coded.groupBy("of").agg(F.sum("error").alias("label_error"))
    out = skew_join(coded, sums, "of", ["id", "code", "error"], ["label_error"])
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
