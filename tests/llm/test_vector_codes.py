"""Vector codes against Lloyd's method in plain Python, and against the oracle SQL."""

import hashlib
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch
from ledgerline.llm.vector_codes import Members, _first_members, compressed, encode, train_codebooks, whole_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, part int, entry string, error double, code int"


def table(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, x, 1, "e", 0.5, 2) for i, v, x in rows], SCHEMA).repartition(parts)


def brute(rows, positions=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], x) for i, v, x in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    w = len(kept[0][1]) // positions
    cut = lambda v: [tuple(v[p * w : (p + 1) * w]) for p in range(positions)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]
    books = [[cut(v)[p] for _, v, _ in order] for p in range(positions)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda part, book: min(range(len(book)), key=lambda e: (dist(part, book[e]), e))
    for _ in range(rounds):
        for p in range(positions):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[nearest(cut(v)[p], books[p])].append(cut(v)[p])
            books[p] = [tuple(sum(c) // len(c) for c in zip(*members[e])) if members[e] else books[p][e] for e in range(len(books[p]))]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], defaultdict(int)
    for i, v, x in kept:
        codes = [nearest(part, b) for part, b in zip(cut(v), books)]
        error = sum(dist(part, b[c]) for part, b, c in zip(cut(v), books, codes))
        out.append((i, "".join(f"{c:02x}" for c in codes), error, x))
        sums[x] += error
    return sorted((str(i), c, e, sums[x], digest) for i, c, e, x in out)


def rows(n=300, seed=2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(12)]
    near = lambda: [float(x + rng.gauss(0, 0.2)) for x in rng.choice(centres)]
    out = [(i, near(), rng.choice([0, 1, 2, None])) for i in range(20, n)]
    hot = [0.25] * 16
    out += [(1000 + i, hot, 5) for i in range(n // 2)]  # a third of all rows: one vector, one label
    out += [(7, near(), 1), (7, near(), 1), (7, hot, 1), (8, out[0][1], 2), (8, out[0][1], 2), (None, near(), None)]
    out += [(1, None, 1), (2, [float("nan")] + [0.0] * 15, 1), (3, [float("inf")] * 16, 1), (4, [None] + [0.0] * 15, 1), (5, [], 1)]
    out += [(6, [0.0] * 16, 1), (9, [-0.0001] * 16, 1)]
    rng.shuffle(out)
    return [(i, v and [float(F32(x)) if x is not None else None for x in v], x) for i, v, x in out]


def F32(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


@pytest.mark.parametrize("parts", [1, 5])
def test_equals_plain_lloyd(spark, parts):
    data = rows()
    got = compressed(table(spark, data, parts), bucket_parts=100)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    expected = brute([r for r in data if r[1] != []])
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == expected


def test_few_and_no_rows(spark):
    few = [(3, [float(x) for x in range(8)], None), (1, [0.5] * 8, 4), (2, None, 4)]
    assert sorted((str(r[0]), *r[1:]) for r in compressed(table(spark, few)).collect()) == brute(few)
    assert compressed(table(spark, few[2:])).count() == 0 and train_codebooks(table(spark, [])) == []


def test_keeps_columns_and_refuses_clashes(spark):
    data = table(spark, [(1, [0.5] * 8, 4)]).drop("error", "code")
    out = encode(data, train_codebooks(data))
    assert out.columns == [*data.columns, "code", "error"] and out.first()["part"] == 1
    with pytest.raises(ValueError):
        encode(table(spark, []), [])
    with pytest.raises(ValueError):
        train_codebooks(table(spark, [(1, [0.5] * 9, 4)]))


def test_only_movers_are_exchanged(spark):
    """Residents are written back without an exchange, and owners add up without one."""
    data = table(spark, rows())
    whole = whole_vectors(data.select("vec_id", F.col("embedding").alias("v")), "v").select("vec_id", "whole")
    books = train_codebooks(data, rounds=0)
    members = Members(Scratch(spark, "test"), 8)
    members.replace(None, _first_members(whole, books, 2, salts=2))
    before = members.read().agg(F.sum("times")).first()[0]
    stay, leave = members.moved(train_codebooks(data, rounds=1), 2)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(stay) and "Exchange" not in plan(leave)
    owned = members.read().groupBy("position", "entry", "salt").count()
    assert "Exchange" not in plan(owned)
    assert 0 < leave.count() < stay.count()
    members.replace(stay, leave)
    assert members.read().agg(F.sum("times")).first()[0] == before
    members.drop()
