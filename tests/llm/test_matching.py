"""Similarity join, substring dedup, chaining and nearest neighbours against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import suffix_dedup as X
from ledgerline.llm import chaining, jaccard
from ledgerline.llm.chaining import CutOff, align, chains, cut_words, remove_repeats, repeated_passages
from ledgerline.llm.common import Scratch
from ledgerline.llm.components import components
from ledgerline.llm.jaccard import keep_one, similar_groups
from ledgerline.llm.nn_descent import nearest
from tests.llm.helpers import DOCS, corpus, make_docs, prose


def grams(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def linked(rows, width, percent):
    """Component (smallest id) of every row by comparing all pairs of sets."""
    sets = [grams(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return [(i, len(sets[k]), low.get(find(k))) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (1, 60)])
def test_similar_groups(spark, width, percent):
    rng = random.Random(width)
    rows = corpus(6)
    for i in range(40):  # a large group of near copies, and strays that share grams with it
        w = rows[5][1].split() * 3
        w[i % len(w)] = f"v{i}"
        rows.append((1000 + i, " ".join(w)))
    rows += [(1100 + i, " ".join(rows[5][1].split()[:40]) + " " + prose(rng, 60)) for i in range(12)]
    got = [tuple(r) for r in similar_groups(make_docs(spark, rows), width=width, percent=percent).select("doc", "n", "component").collect()]
    assert sorted(got, key=repr) == sorted(linked(rows, width, percent), key=repr)


def test_keep_one(spark):
    rows = corpus(7)
    docs = make_docs(spark, rows)
    out = keep_one(docs)
    assert out.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    want = Counter()
    for (i, t), (_, n, low) in zip(rows, linked(rows, 5, 80)):
        if not n:
            want[i, t] += 1
        elif i == low:
            want[i, t] = 1
    # rows of one id and different texts in a component cannot both be told to go
    assert set(got) == set(want) and all(got[k] == want[k] for k in got)
    none = spark.createDataFrame([], DOCS)
    assert keep_one(none).count() == 0 and similar_groups(none).count() == 0


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 2000 + i) for i in range(80)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint"), Scratch(spark, "test")).collect()}
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in pairs:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert got == {x: find(x) for x in root}


def test_lpf_array():
    rng = random.Random(2)
    share = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    for _ in range(60):
        t = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40)))
        order, levels = X.suffix_array(np.frombuffer(t, np.uint8).astype(np.int64), 64)
        common = X.common_prefixes(order, levels)
        assert [t[i:] for i in order] == sorted(t[i:] for i in range(len(t)))
        assert common[1:].tolist() == [share(t[a:], t[b:]) for a, b in zip(order, order[1:])]
        assert X.lpf_array(order, common).tolist() == [max([share(t[i:], t[:j] and t[j:] or t[j:]) for j in range(i)], default=0) for i in range(len(t))]


def test_settled_suffixes_are_not_sorted_again(monkeypatch):
    rng, sorted_, argsort = random.Random(4), [], np.argsort
    passage = bytes(rng.choice(b"abcdefgh") for _ in range(90))
    texts = [bytes(rng.choice(b"abcdefgh") for _ in range(300)) + passage[: 40 + 10 * k] + b"." * k for k in range(5)]
    monkeypatch.setattr(np, "argsort", lambda x, *a, **b: sorted_.append(len(x)) or argsort(x, *a, **b))
    got = X.repeated_windows(texts, 50)
    for k, (t, (anywhere, earlier)) in enumerate(zip(texts, got)):
        for i in range(len(t) - 49):
            w = t[i : i + 50]
            places = [(m, j) for m, u in enumerate(texts) for j in range(len(u) - 49) if u[j : j + 50] == w]
            assert (bool(anywhere[i]), bool(earlier[i])) == (len(places) > 1, min(places) < (k, i))
    assert sum(sorted_) < 3 * sum(map(len, texts))


def test_lists_of_two_are_settled_by_their_one_pair(spark, monkeypatch):
    told, within = [], jaccard._within

    def counted(rows, percent):
        told.append(rows.count())
        return within(rows, percent)

    monkeypatch.setattr(jaccard, "_within", counted)
    # pairs that share their last gram, and are no near copies
    rows = [(10 * k + j, f"a{k}{j} b{k}{j} c{k}{j} x{k} y{k} z{k}") for k in range(12) for j in range(2)]
    groups = jaccard.similar_groups(make_docs(spark, rows), percent=10)
    apart = jaccard.similar_groups(make_docs(spark, rows), percent=25)
    assert {r["component"] for r in groups.collect()} == {10 * k for k in range(12)}
    assert {r["component"] for r in apart.collect()} == {i for i, _ in rows}
    assert told == [0, 0]


def test_pairs_of_families_are_made_once_and_nothing_stays_on_disk(spark, monkeypatch):
    rng = random.Random(17)
    rows = []
    for family in range(4):  # near copies of which some are linked and some are not
        base = [f"w{rng.randrange(10000)}" for _ in range(200)]
        for i in range(24):
            w = list(base)
            for _ in range(rng.randint(2, 5)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((100 * family + i, " ".join(w)))
    made, folders, within, begin = [], [], jaccard._within, Scratch.__init__

    def counted(still, percent):
        pairs = within(still, percent)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    def noted(self, spark, label):
        begin(self, spark, label)
        folders.append(self.base)

    monkeypatch.setattr(jaccard, "_within", counted)
    monkeypatch.setattr(Scratch, "__init__", noted)
    got = {r["doc"]: (r["n"], r["component"]) for r in similar_groups(make_docs(spark, rows)).collect()}
    assert got == {i: (n, c) for i, n, c in linked(rows, 3, 90)}
    ((n, distinct),) = made
    assert distinct <= n <= 1.2 * distinct  # a row for each common gram of a pair before
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for f in folders:  # groups are a table of their own
        path = hadoop.Path(f)
        assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_pairs_just_too_different_are_not_made(spark, monkeypatch):
    rng = random.Random(22)
    base, rows = prose(rng, 400).split(), []
    for i in range(60):  # 6 words make two copies 120 grams apart, where 88 are allowed; 2 words make them linked
        copy = list(base)
        for j in rng.sample(range(400), 6 if i < 50 else 2):
            copy[j] = f"own{i}x{j}"
        rows.append((i, " ".join(copy)))
    made, within = [], jaccard._within

    def counted(told, percent):
        pairs = within(told, percent)
        made.append(pairs.distinct().count())
        return pairs

    monkeypatch.setattr(jaccard, "_within", counted)
    got = {r["doc"]: (r["n"], r["component"]) for r in similar_groups(make_docs(spark, rows), width=5, percent=80).collect()}
    assert got == {i: (n, c) for i, n, c in linked(rows, 5, 80)}
    assert made[0] <= 900  # 1659 with 256 hash ranges


def cut(rows, size, first_stays):
    """Bytes that stay in each row, by counting all strings of ``size`` bytes."""
    data = [(t or "").encode() for _, t in rows]
    seen = {}
    for k, ((i, _), b) in sorted(enumerate(zip(rows, data)), key=lambda x: (x[1][0][0] is not None, x[1][0][0] or 0, hashlib.md5(x[1][1]).digest())):
        for p in range(len(b) - size + 1):
            seen.setdefault(b[p : p + size], []).append((k, p))
    gone = [bytearray(len(b)) for b in data]
    for places in seen.values():
        one = places[0]
        same = {(rows[k][0], data[k], p) for k, p in places}
        if len(places) > 1:
            for k, p in places:
                if first_stays and (rows[k][0], data[k], p) == (rows[one[0]][0], data[one[0]], one[1]):
                    continue
                if not first_stays or len(same) > 1:
                    gone[k][p : p + size] = b"\1" * size
    return [(rows[k][0], len(b), sum(g), sum(g[p] and not (p and g[p - 1]) for p in range(len(g))), hashlib.sha256(bytes(x for x, y in zip(b, g) if not y)).hexdigest()) for k, (b, g) in enumerate(zip(data, gone))]


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("hot_blocks", [512, 3])
def test_substrings(spark, keep_first, hot_blocks):
    rng = random.Random(8)
    rows = corpus(8)
    passage = prose(rng, 40)
    rows += [(1000 + i, f"{prose(rng, 5)} {passage}{rng.choice('abc')} {prose(rng, 5)}") for i in range(20)] + [(1100, "ab" * 400)]
    size = 64
    got = X.dedup_substrings(make_docs(spark, rows), min_bytes=size, keep_first=keep_first, hot_blocks=hot_blocks)
    got = [tuple(r) for r in got.drop("kept").collect()]
    assert sorted(got, key=repr) == sorted(cut(rows, size, keep_first), key=repr)


def test_hot_blocks_are_not_cut_into_all_their_windows(spark, monkeypatch):
    rng = random.Random(9)
    passage = prose(rng, 120)
    rows = [(i, f"{prose(rng, 80, 4000)} {passage} {prose(rng, 80, 4000)}") for i in range(40)]
    sizes, write = {}, Scratch.write

    def counted(self, df):
        out = write(self, df)
        if "many" in df.columns and "c" in df.columns:
            sizes[out[1]] = out[0].count()
        return out

    monkeypatch.setattr(Scratch, "write", counted)
    got = X.dedup_substrings(make_docs(spark, rows), keep_first=False, hot_blocks=3)
    assert sorted((tuple(r) for r in got.drop("kept").collect()), key=repr) == sorted(cut(rows, 400, False), key=repr)
    blocks = sum(1 for _, t in rows for _ in X.blocks_of(t.encode()))
    assert len(sizes) == len(X.STEPS) and max(sizes.values()) <= 9 * blocks  # up to 353 rows for a block before


def test_substrings_of_nothing(spark):
    assert X.dedup_substrings(spark.createDataFrame([], DOCS)).count() == 0


def test_chains_are_collinear_and_best():
    assert chains([]) == []
    (best, *rest) = chains([(0, 10), (5, 15), (7, 2), (20, 30), (21, 200)])
    assert best == [(0, 10), (5, 15), (20, 30)] and sorted(map(len, rest)) == [1, 1]
    rng = random.Random(3)
    for _ in range(50):
        for c in chains([(rng.randrange(40), rng.randrange(40)) for _ in range(25)]):
            assert all(a < x and b < y for (a, b), (x, y) in zip(c, c[1:]))


def test_passages(spark):
    rng = random.Random(11)
    text = lambda n: prose(rng, n, 5000)
    passage = text(80)
    fuzzy = passage.split()
    for k in (13, 37, 61):
        fuzzy[k] = "changed"
    inside = fuzzy[:50] + ["added", "words"] + fuzzy[50:]
    rows = [(i, text(rng.randint(20, 200))) for i in range(60)]
    rows += [(100, f"{text(30)} {passage} {text(30)}"), (101, f"{text(9)}\n{passage}\n{text(12)}"), (102, f"{text(70)} {' '.join(fuzzy)}"), (103, f"{' '.join(inside)} {text(40)}")]
    rows += [(200 + i, rows[7][1]) for i in range(5)] + [(300, None), (301, ""), (302, "a b"), (None, text(50))]
    docs = make_docs(spark, rows)
    got = repeated_passages(docs).collect()
    spans = {}
    for r in got:
        spans.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"], r["source_id"]))
    long_copy = len(rows[7][1].split()) >= 40
    assert set(spans) == {101, 102, 103} | ({200 + i for i in range(5)} if long_copy else set())
    assert spans[101] == [(9, 89, 100)]
    for i, a, n in ((102, 70, 80), (103, 0, 82)):
        ((start, end, _),) = spans[i]
        assert abs(start - a) <= 2 and abs(end - a - n) <= 2
    assert all(r["similarity"] >= 0.8 for r in got)
    cut_docs = {r["doc_id"]: r["text"] for r in remove_repeats(docs).where("doc_id >= 100").collect()}
    assert cut_docs[101].split() == rows[61][1].split()[:9] + rows[61][1].split()[89:]
    assert cut_docs[100] == rows[60][1] and cut_docs[300] is None
    assert repeated_passages(spark.createDataFrame([], DOCS)).count() == 0
    assert cut_words(" a  b c ", [(1, 2)]) == " a   c "


def test_passages_of_planted_seeds(spark):
    rng = random.Random(12)
    text = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    join = " ".join
    rows = []
    for i, n in enumerate((40, 47, 75)):  # every short stretch of them was somewhere before, each in a text of its own
        passage = text(n)
        rows += [(100 * i + j, join(text(20) + passage[j : j + 8] + text(20))) for j in range(n - 7)]
        rows += [(1000 + i, join(text(30) + passage + text(30))), (2000 + i, join(text(9) + passage + text(12)))]
    got = repeated_passages(make_docs(spark, rows)).collect()
    assert sorted(tuple(r)[:6] for r in got) == [(2000 + i, 9, 9 + n, 1000 + i, 30, 30 + n) for i, n in enumerate((40, 47, 75))]


def test_recall_of_changed_passages(spark):
    rng = random.Random(13)
    text = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    rows, wanted = [], {}
    for i, (n, share) in enumerate([(n, share) for n in (50, 60, 80) for share in (0.05, 0.1, 0.15, 0.19) for _ in range(10)]):
        passage = text(n)
        changed = list(passage)
        for k in rng.sample(range(n), int(n * share)):
            changed[k] = text(1)[0]
        rows += [(i, " ".join(text(30) + passage + text(30))), (1000 + i, " ".join(text(25) + changed + text(35)))]
        wanted[1000 + i] = (i, n)
    got = {r["doc_id"]: (r["source_id"], r["start_word"], r["end_word"]) for r in repeated_passages(make_docs(spark, rows)).collect()}
    near = [i for i, (source, n) in wanted.items() if i in got and got[i][0] == source and min(got[i][2], 25 + n) - max(got[i][1], 25) >= 0.7 * n]
    assert set(got) <= set(wanted) and len(near) >= 0.98 * len(wanted)


def near_truth(rows, k):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    dim = max(len(v) for _, v in usable)
    usable = [(i, v) for i, v in usable if len(v) == dim]
    out = {}
    for q, (i, v) in enumerate(usable):
        others = sorted(((-float(v @ w), j) for c, (j, w) in enumerate(usable) if c != q))
        out[i] = [(j, -s) for s, j in others[:k]]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[200:420] = x[7]  # one vector that many rows have
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(2000, None), (2001, [0.0] * 24), (2002, [float("nan")] + [1.0] * 23), (2003, [None] + [1.0] * 23), (2004, [1.0]), (None, rows[3][1]), (2005, [float("inf")] + [0.0] * 23), (2020, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(3)).withColumn("score", F.lit(1.0)).repartition(4)
    truth = near_truth(rows, 20)
    got = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    queries = [i for i in truth if i % 20 == 0]
    assert set(got) == set(queries)
    vectors = {i: np.array(v, float) for i, v in rows[:1500]}
    recall = []
    for q in queries:
        assert [r for r, _, _ in got[q]] == list(range(1, 21)) and q not in {i for _, i, _ in got[q]}
        assert all(abs(vectors[q] @ vectors[i] - s) < 1e-12 for _, i, s in got[q])
        assert [(-s, i) for _, i, s in got[q]] == sorted((-s, i) for _, i, s in got[q])
        recall.append(len({i for _, i, _ in got[q]} & {i for i, _ in truth[q]}) / 20)
    assert np.mean(recall) >= 0.95
    assert [i for _, i, _ in got[220]] == [i for i, _ in truth[220]]  # ties go to the smallest ids


def test_nearest_of_clusters_and_outliers(spark):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((3, 32))
    x = np.concatenate([centres[rng.integers(0, 3, 3960)] + 0.05 * rng.standard_normal((3960, 32)), rng.standard_normal((40, 32))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>").repartition(4)
    got = {}
    for r in nearest(df, (F.col("vec_id") % 40 == 0) | (F.col("vec_id") >= 3960)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    queries = [i for i in range(4000) if i % 40 == 0 or i >= 3960]
    score = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(score, -np.inf)
    assert all(len(got.get(q, ())) == 20 for q in queries)  # an outlier, too, has its 20
    share = {q: len(got[q] & {*np.argsort(-score[q])[:20].tolist()}) / 20 for q in queries}
    inside, outside = ([s for q, s in share.items() if (q >= 3960) == o] for o in (False, True))
    assert np.mean(inside) >= 0.95 and np.mean(outside) >= 0.9, (np.mean(inside), np.mean(outside))


def test_an_id_with_two_vectors_is_two_queries(spark):
    rng = random.Random(8)
    vector = lambda: [rng.gauss(0, 1) for _ in range(16)]
    rows = [(i, vector()) for i in range(300)] + [(20, vector()), (20, vector())]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = nearest(docs, F.col("vec_id") % 20 == 0, k=5).collect()
    assert len(got) == 5 * (15 + 2)
    mine = Counter(r["rank"] for r in got if r["query_id"] == 20)
    assert mine == {rank: 3 for rank in range(1, 6)}


def test_nearest_small_tables(spark):
    rows = [(i, [float(i), 1.0]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = nearest(df, F.col("vec_id") >= 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [(q, i, s) for q, near in sorted(near_truth(rows, 20).items()) for i, s in near]
    assert nearest(df.limit(0), F.col("vec_id") >= 0).count() == 0
    assert nearest(df.limit(1), F.col("vec_id") >= 0).count() == 0


def test_alignment_of_parts_is_that_of_whole_texts():
    rng, settled = random.Random(5), 0
    for _ in range(300):
        a = np.array([rng.randrange(1000) for _ in range(rng.randint(60, 200))], np.uint32)
        b = np.concatenate([np.array([rng.randrange(1000) for _ in range(rng.randint(0, 80))], np.uint32), a[rng.randrange(20) :], a[: rng.randrange(1, 40)]])
        b[[rng.randrange(len(b)) for _ in range(rng.randrange(25))]] = 5000
        at = {tuple(b[q : q + 4]): q for q in range(len(b) - 3)}
        matches = [(p, at[w]) for p in range(0, len(a) - 3, 3) if (w := tuple(a[p : p + 4])) in at]
        for c in chains(matches):
            want, margin = align(c, a, b), rng.choice((0, 3, 8, 20, 64))
            a0, a1, b0, b1 = max(0, c[0][0] - margin), min(len(a), c[-1][0] + 4 + margin), max(0, c[0][1] - margin), min(len(b), c[-1][1] + 4 + margin)
            try:
                got = align([(p - a0, q - b0) for p, q in c], a[a0:a1], b[b0:b1], left_out=(a0, len(a) - a1, b0, len(b) - b1))
            except CutOff:
                continue
            assert [(s + a0, e + a0, f + b0, t + b0, m) for s, e, f, t, m in got] == want
            settled += 1
    assert settled > 100


def test_passages_are_the_same_whatever_part_of_a_text_meets_first(spark, monkeypatch):
    docs = make_docs(spark, corpus(4))
    runs = []
    for margin in (64, 0):
        monkeypatch.setattr(chaining, "MARGIN", margin)
        # which of several equal sources a passage names is open
        runs.append(sorted(repr(tuple(r)) for r in repeated_passages(docs).select("doc_id", "start_word", "end_word").collect()))
    assert runs[0] == runs[1] and len(runs[0]) > 20
