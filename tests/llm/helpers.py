"""Small tables for the tests of the training-data operators."""

import random

DOCS = "doc_id bigint, text string, n bigint, key string, component bigint, kept boolean, source string"


def make_docs(spark, rows, parts=3):
    """Documents from ``(doc_id, text)``, with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, 7, "k", -1, None, "s") for i, t in rows], DOCS).repartition(parts)


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    """Words of a made-up vocabulary, common ones first."""
    return " ".join(f"w{min(int(rng.expovariate(6 / vocabulary)), vocabulary - 1)}" for _ in range(words))


def corpus(seed: int = 1) -> list:
    """Documents with copies, near copies, shared passages, nulls, blanks, repeated ids and rows, and a long text."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(3, 160)) for _ in range(60)]
    passage = prose(rng, 90)
    rows = list(enumerate(base))
    rows += [(100 + i, base[i]) for i in range(10)]
    for i in range(10, 30):
        w = base[i].split()
        w[rng.randrange(len(w))] = "edited"
        rows.append((200 + i, " ".join(w)))
    for i in range(30, 42):
        rows.append((300 + i, f"{prose(rng, 30)} {passage} {prose(rng, 25)}"))
    rows += [(400 + i, base[7]) for i in range(25)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "one"), (504, "Two Words"), (505, "two words")]
    rows += [(None, base[3]), (None, "null id"), (3, base[5]), (6, base[6]), (6, base[6])]
    rows.append((600, prose(rng, 6000)))
    rows.append((601, "word " * 900))
    rows.append((602, "é中 ßÄ “x” " * 60 + "x" * 3000))
    return rows
