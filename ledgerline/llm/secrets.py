"""Secret scans: fixed patterns, and a randomness test battery under false-discovery control.

Patterns find assigned secrets, access keys and long hexadecimal runs.  The
battery looks at every other run of 20 or more token characters.  Its
encoding is inferred from the characters in it, each character becomes its
place in that alphabet, and three tests ask whether the sequence could be
uniform noise:

* chi-squared uniformity over the alphabet (too uneven),
* the number of runs above and below the middle of the alphabet,
* serial correlation of neighbours.

Fisher's method combines them to one p-value; a token *fits* noise if that is
at least ``FITS``.  Short tokens give the tests little to reject, so a token
must also be unlike text: noise changes its class of characters (capital,
small letter, digit, other; for digits alone, even and odd) at nearly every
other character, text seldom.  What text does is learned from all tokens of
the corpus that do not fit noise, whatever their length, shrunk towards a
stated rate; from it follows the chance that a text-like token of this length
changes class so often.  How often text fits noise by chance is learned the
same way, from the tokens that change class no more than text does; the product
is the token's chance under text.  Over all tokens together the Benjamini-Hochberg rule
accepts the smallest chances, so that the expected share of text among what is
accepted stays within ``fdr``: one strong token is found alone, whatever else
its class holds, and a corpus of many tokens asks for stronger ones.

All of it is DataFrame functions on whole texts; rows are never joined, and
the cut-offs (one for each length class) are found first, by a job of their
own over counts by length class and rate: the plan that marks the texts holds
the expressions above once, and the driver never plans both together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import free_names, let

# The base patterns.  Letters of the names count in either case.
NAME = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = rf"""({NAME})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of 16 or more; shorter ones fail whole, as their tails are shorter still.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")

#: Alphabets by encoding: pattern of the whole token and its symbols in order.
ENCODINGS = {
    "decimal": ("^[0-9]+$", "0123456789"),
    "hex": ("^[0-9a-f]+$", "0123456789abcdef"),
    "upper_hex": ("^[0-9A-F]+$", "0123456789ABCDEF"),
    "lower36": ("^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    "upper36": ("^[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "base64": ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
}
#: Combined p-value from which on a token fits noise, and its least length.
FITS, SHORTEST = 0.001, 16
FDR = 0.1
#: Changes of class per neighbouring pair in text: mean and spread expected beforehand, and the tokens that this counts for.
TEXT_RATE, TEXT_SPREAD, TEXT_TOKENS = 0.10, 0.08, 50
#: Share of text-like tokens that fit noise, as expected beforehand.
TEXT_FITS = 0.05
#: Rates are counted in steps of this many to 1.
STEPS = 100


def matches(text: Column, pattern: str, kind: int, group: int = 0, shortest: int = 1) -> Column:
    """Spans ``(start, end, kind)`` of the leftmost non-overlapping matches; ``group`` has ``shortest`` code points at least.

    The texts between matches and the matches themselves alternate, so their
    lengths add up to positions.
    """
    empty = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    found, checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.zip_with(
        F.zip_with(found, checked, lambda m, g: F.struct(F.length(m).alias("m"), F.length(g).alias("g"))),
        F.transform(F.split(text, pattern, -1), F.length),
        lambda m, gap: F.struct(gap.alias("gap"), m["m"].alias("m"), m["g"].alias("g")),
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["m"]
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"))
        return F.struct(
            end.alias("at"), F.when(x["g"] >= shortest, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out")
        )

    # the last gap has no match behind it
    spans = F.aggregate(F.filter(steps, lambda x: x["m"].isNotNull()), F.struct(F.lit(0).alias("at"), empty.alias("out")), step)["out"]
    likely = pattern if group == 0 else pattern[:-2] + f"{{{shortest},}})"
    return F.when(text.rlike(likely), spans).otherwise(empty)


def encoding(token: Column) -> Column:
    out = F.lit("base64")
    for name in reversed([*ENCODINGS][:-1]):
        out = F.when(token.rlike(ENCODINGS[name][0]), F.lit(name)).otherwise(out)
    return out


def length_class(n: Column) -> Column:
    """Classes of eight characters up to 64, of doubling widths beyond."""
    return F.when(n < 64, F.floor(n / 8).cast("int")).otherwise(F.lit(2) + F.floor(F.log2(n)).cast("int"))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic approximation)."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def battery(token: Column, enc: Column) -> Column:
    """Combined p-value of the three tests for a token without padding."""
    alphabet = F.lit(ENCODINGS["base64"][1])
    for name in [*ENCODINGS][:-1]:
        alphabet = F.when(enc == name, F.lit(ENCODINGS[name][1])).otherwise(alphabet)
    plain = F.when(enc == "base64", F.replace(F.replace(token, F.lit("-"), F.lit("+")), F.lit("_"), F.lit("/"))).otherwise(token)

    def tests(v: Column) -> Column:  # v: symbols' places, alphabet size and sum of squared symbol counts
        x, size, squares = v["x"], v["a"].cast("double"), v["s"].cast("double")
        n = F.size(x).cast("double")
        add = lambda f: F.aggregate(f, F.lit(0.0), lambda acc, y: acc + y)
        after = F.slice(x, 2, F.size(x))
        pairs = lambda f: F.filter(F.zip_with(x, after, f), lambda y: y.isNotNull())
        chi = (size / n * squares - n - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
        high = add(F.transform(x, lambda y: F.when(2 * y >= v["a"], F.lit(1.0)).otherwise(F.lit(0.0))))
        low = n - high
        runs = 1 + add(pairs(lambda a, b: F.when(b.isNull(), None).when((2 * a >= v["a"]) != (2 * b >= v["a"]), 1.0).otherwise(0.0)))
        expected = 2 * high * low / n + 1
        spread = F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9)))
        mean = add(F.transform(x, lambda y: y.cast("double"))) / n
        var = add(F.transform(x, lambda y: (y - mean) * (y - mean)))
        lag = add(pairs(lambda a, b: F.when(b.isNotNull(), (a - mean) * (b - mean))))
        serial = F.when(var > 0, (lag / var + 1 / n) * F.sqrt(n)).otherwise(F.lit(8.0))
        p = [_tail(chi), 2 * _tail(F.abs((runs - expected) / spread)), 2 * _tail(F.abs(serial))]
        half = -sum(F.log(F.greatest(q, F.lit(1e-12))) for q in p)
        return F.exp(-half) * (1 + half + half * half / 2)

    def bound(t: Column, a: Column) -> Column:
        counts = F.transform(F.split(a, ""), lambda c: F.length(t) - F.length(F.replace(t, c, F.lit(""))))
        squares = F.aggregate(counts, F.lit(0), lambda acc, c: acc + c * c)
        places = F.transform(F.split(t, ""), lambda c: F.instr(a, c) - 1)
        return F.struct(places.alias("x"), F.length(a).alias("a"), squares.alias("s"))

    return let(plain, lambda t: let(alphabet, lambda a: let(bound(t, a), tests)))


def changes(token: Column, enc: Column) -> Column:
    """How often neighbouring characters differ in class."""
    capital, small, digit = (ENCODINGS["base64"][1][i:j] for i, j in ((0, 26), (26, 52), (52, 62)))
    mixed = F.translate(token, capital + small + digit + "+/-_=", "A" * 26 + "a" * 26 + "0" * 10 + "+" * 5)
    classes = F.when(enc == "decimal", F.translate(token, digit, "01" * 5)).otherwise(mixed)
    return F.regexp_count(classes, F.lit(r"(?s)(.)(?!\1)(?=.)"))


def candidates(text: Column, base: Column) -> Column:
    """Tokens that no base span touches: ``(start, end, kind, cls, rate, fits)``, with the rate in whole steps."""

    def judged(s: Column) -> Column:
        token = F.rtrim(F.substring(text, s["start"] + 1, s["end"] - s["start"]), F.lit("="))
        return let(
            token,
            lambda t: let(
                encoding(t),
                lambda e: F.struct(
                    s["start"].alias("start"),
                    s["end"].alias("end"),
                    s["kind"].alias("kind"),
                    length_class(F.length(t)).alias("cls"),
                    F.when(F.length(t) > 1, F.floor(STEPS * changes(t, e) / (F.length(t) - 1)).cast("int")).otherwise(0).alias("rate"),
                    F.when(F.length(t) >= SHORTEST, battery(t, e) >= FITS).otherwise(F.lit(False)).alias("fits"),
                ),
            ),
        )

    found = let(
        matches(text, CANDIDATE, KINDS.index("random")),
        lambda c: F.filter(c, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))),
    )
    return F.transform(found, judged)


def cut_offs(scanned: DataFrame, fdr: float = FDR) -> DataFrame:
    """One row, ``cuts``: length class to the smallest rate of an accepted token, for classes that accept any.

    A cell (class, rate) counts as its least telling token: the shortest length, the rate rounded down.
    """
    # the whole struct is the key: with its fields as keys the candidates would be computed for each of them
    cell = F.transform("__candidates", lambda c: F.struct(c["cls"].alias("cls"), c["rate"].alias("rate"), c["fits"].alias("fits")))
    cells = scanned.select(F.explode(cell).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).select("c.*", "n")
    x, plain, own = F.col("rate") / STEPS, F.when(F.col("fits"), 0).otherwise(F.col("n")), float(TEXT_TOKENS)
    every = W.partitionBy()  # at most length classes x steps x 2 rows
    weight = F.sum(plain).over(every) + own
    mean = (F.sum(plain * x).over(every) + own * TEXT_RATE) / weight
    square = (F.sum(plain * x * x).over(every) + own * (TEXT_RATE**2 + TEXT_SPREAD**2)) / weight
    known = cells.select("cls", "rate", "fits", "n", x.alias("x"), mean.alias("mean"), (square - mean * mean).alias("var"), F.sum("n").over(every).alias("m"))
    shortest = F.greatest(F.when(F.col("cls") < 8, 8 * F.col("cls")).otherwise(F.pow(F.lit(2.0), F.col("cls") - 2)), F.lit(SHORTEST))
    z = (F.col("x") - F.col("mean")) / F.sqrt(F.col("var") + F.col("mean") * (1 - F.col("mean")) / (shortest - 1))
    calm = F.when(F.col("x") <= F.col("mean"), F.col("n")).otherwise(0)
    fitting = F.sum(F.when(F.col("fits"), calm).otherwise(0)).over(every) + own * TEXT_FITS
    known = known.withColumn("fit", fitting / (F.sum(calm).over(every) + own))
    chance = known.where("fits").select("cls", "rate", "n", "m", (F.col("fit") * _tail(z)).alias("q"))
    so_far = F.sum("n").over(W.orderBy("q").rangeBetween(W.unboundedPreceding, W.currentRow))
    held = chance.withColumn("holds", F.col("m") * F.col("q") <= fdr * so_far)
    last = F.max(F.when(F.col("holds"), F.col("q"))).over(W.partitionBy())
    accepted = held.withColumn("last", last).where(F.col("q") <= F.col("last"))
    cuts = accepted.groupBy("cls").agg(F.min("rate").alias("rate"))
    return cuts.agg(F.map_from_entries(F.collect_list(F.struct("cls", "rate"))).alias("cuts"))


def with_spans(docs: DataFrame, text_col: str = "text", fdr: float = FDR, name: str = "__spans") -> DataFrame:
    """``docs`` and an array column ``name`` of all spans ``(start, end, kind)``, in code points, by start and kind.

    ``kind`` is an index into :data:`KINDS`.  Base spans are always there;
    the battery adds tokens that overlap none of them.  Null texts are empty
    and have no spans; an empty table gives an empty result.
    """
    if name in docs.columns:
        raise ValueError(f"{name} is taken")
    own = whole, base, found = free_names(docs, "__text", "__base", "__candidates")
    scanned = docs.withColumn(whole, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    t = F.col(whole)
    scanned = scanned.withColumn(base, F.concat(matches(t, ASSIGN, 0, 2, 8), matches(t, ACCESS, 1), matches(t, HEX, 2)))
    scanned = scanned.withColumn(found, candidates(t, F.col(base)))
    # an entry for each length class at most
    cuts = cut_offs(scanned.select(F.col(found).alias("__candidates")), fdr).first()["cuts"]
    m = F.create_map(*(F.lit(x) for entry in sorted(cuts.items()) for x in entry)).cast("map<int,int>")
    added = F.transform(
        F.filter(found, lambda c: c["fits"] & F.coalesce(c["rate"] >= F.try_element_at(m, c["cls"]), F.lit(False))),
        lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")),
    )
    spans = F.transform(
        F.array_sort(
            F.transform(F.concat(base, added), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))),
        ),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return scanned.withColumn(name, spans).drop(*own)


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """``id_col, n_assign, n_access, n_hex, base_sha256, spans`` of every whole text, a row for each input row."""
    s = F.col("__spans")
    many = lambda kind: F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("bigint")
    base = F.filter(s, lambda x: x["kind"] < 3)
    return with_spans(docs.select(id_col, text_col), text_col, fdr).select(
        id_col,
        many(0).alias("n_assign"),
        many(1).alias("n_access"),
        many(2).alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(s).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """``docs`` with every span replaced by ``mask``; overlapping spans become one mask, nulls stay null.

    Repeated rows stay repeated, other columns are kept whatever their names, and
    an empty table gives an empty result.
    """
    (spans,) = free_names(docs, "__spans")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col(f"`{text_col}`")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"]).alias("out"),
        )

    done = let(
        F.aggregate(spans, start, step), lambda r: F.concat(r["out"], F.substring(text, r["at"] + 1, F.length(text)))
    )
    masked = F.when(F.size(spans) == 0, text).otherwise(done)
    return with_spans(docs, text_col, fdr, spans).select(*((masked if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns))
