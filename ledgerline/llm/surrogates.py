"""PII surrogates: keyed, type-consistent replacements that keep distinct entities distinct.

Detection is a set of patterns (e-mail and IP addresses, card, phone and
social security numbers) and person names (a given name of the lists below and
a capitalised surname).  Every different entity of the corpus gets one
surrogate, so mentions stay coreferent, within a document and across them:

* digits become digits, letters letters of the same case, punctuation and
  length stay (a phone keeps its country code, an address its labels and its
  last one, a card its first digit and a valid check digit, IP parts stay
  below 256);
* given names become others of the same gender and script, surnames are built
  from syllables of the same script.

What a surrogate looks like follows from a keyed hash of type, entity and
attempt.  A collision check over all entities redraws, with the next attempt,
every surrogate that another entity has too or that is itself an entity of the
corpus; the attempt that stands is part of the mapping.

All of it is DataFrame functions.  Entities meet by their own text, documents
by a digest of theirs, so that copies are rewritten once and null or repeated
ids do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, let

# Given names by script and gender, syllables of surnames by script.
GIVEN = {
    ("latin", "f"): "Alice Anna Carla Clara Diana Elena Emma Eva Hanna Helen Ida Irene Jana Julia Laura Lena Maria Marta Nina Nora Olga Paula Rosa Sara Sofia".split(),
    ("latin", "m"): "Adam Anton Bruno Carl Daniel David Emil Erik Felix Frank Hugo Ivan Jakob Jonas Karl Leon Lukas Marco Martin Oscar Paul Peter Robert Simon Thomas".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Софья Татьяна".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Дмитрий Иван Максим Олег Павел Сергей Юрий".split(),
}
SYLLABLES = {
    "latin": "ba bel bor cas dan del dor fal fen gar hal hol jar kal ker lan lem lor mar mel mor nal nor ost pal per rad rem ros sal sen tal tem tor val ver vik wal wen zor".split(),
    "cyrillic": "ба бел бор вал вер гор дан дор жар зор кал кер лан лем лор мар мел мор нор пал".split(),
}

_NAMES = "|".join(n for names in GIVEN.values() for n in names)
#: Types by priority; where patterns meet at one place, the earlier wins.
TYPES = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])[3-8][0-9]{3}(?:[ -]?[0-9]{4}){3}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "name": rf"(?<!\p{{L}})(?:{_NAMES}) \p{{Lu}}\p{{Ll}}+(?!\p{{L}})",
}
PATTERN = "(?:" + "|".join(TYPES.values()) + ")"
KEY = "public-demo-key"
#: Redraws before a surrogate is lengthened by its attempt's digits.
ATTEMPTS = 16


def entities(text: Column) -> Column:
    """Leftmost non-overlapping entities of a text, in order."""
    return F.when(text.rlike(PATTERN), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def entity_type(entity: Column) -> Column:
    out = F.lit("name")
    for name in reversed([*TYPES][:-1]):
        out = F.when(entity.rlike(f"^{TYPES[name]}$"), F.lit(name)).otherwise(out)
    return out


def _nibble(digest: Column, i: Column) -> Column:
    """Two hex digits of the digest, as a number, for place ``i``."""
    return F.conv(F.substring(digest, F.pmod(i * 2, F.lit(62)) + 1, F.lit(2)), 16, 10).cast("int")


def _same_shape(entity: Column, digest: Column) -> Column:
    """Digits for digits, letters for letters of the same case; everything else stays."""

    def one(c: Column, i: Column) -> Column:
        n = _nibble(digest, i) + i * 7
        return (
            F.when(c.rlike("[0-9]"), F.substring(F.lit("0123456789"), n % 10 + 1, F.lit(1)))
            .when(c.rlike("[a-z]"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), n % 26 + 1, F.lit(1)))
            .when(c.rlike("[A-Z]"), F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), n % 26 + 1, F.lit(1)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(entity, ""), one), "")


def _luhn(number: Column) -> Column:
    """A card number with its last digit made to fit the others."""

    def fitted(body: Column) -> Column:
        digits = F.reverse(F.split(F.regexp_replace(body, "[^0-9]", ""), ""))
        weighed = F.transform(digits, lambda d, i: F.when(i % 2 == 0, 2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
        check = F.pmod(-F.aggregate(weighed, F.lit(0), lambda acc, x: acc + x), F.lit(10))
        return F.concat(body, check.cast("string"))

    return let(F.substring(number, F.lit(1), F.length(number) - 1), fitted)


def _person(entity: Column, digest: Column) -> Column:
    given, surname = F.substring_index(entity, " ", 1), F.substring_index(entity, " ", -1)
    out = entity
    for (script, gender), names in GIVEN.items():
        parts = F.array(*map(F.lit, SYLLABLES[script]))
        syllable = lambda k: F.get(parts, _nibble(digest, F.lit(k)) % len(SYLLABLES[script]))  # noqa: E731, B023
        built = F.initcap(F.concat(syllable(1), syllable(2), F.when(F.length(surname) > 5, syllable(3)).otherwise("")))
        name = F.get(F.array(*map(F.lit, names)), _nibble(digest, F.lit(0)) % len(names))
        out = F.when(given.isin(names), F.concat_ws(" ", name, built)).otherwise(out)
    return out


def surrogate(kind: Column, entity: Column, attempt: Column, key: str = KEY) -> Column:
    """The replacement that the key, the type, the entity and the attempt give."""

    def drawn(d: Column) -> Column:
        at = F.instr(entity, "@")
        tail = F.substring_index(entity, ".", -1)
        host = F.substring(entity, at + 1, F.length(entity) - at - F.length(tail))
        email = F.concat(_same_shape(F.substring(entity, F.lit(1), at - 1), d), F.lit("@"), _same_shape(host, F.reverse(d)), tail)
        ip = F.array_join(F.transform(F.split(entity, r"\."), lambda x, i: (_nibble(d, i + 1) % 254 + 1).cast("string")), ".")
        card = _luhn(F.concat(F.substring(entity, 1, 1), _same_shape(F.substring(entity, F.lit(2), F.length(entity)), d)))
        country = F.regexp_extract(entity, r"^\+[0-9]{1,3}[ .-]?", 0)
        phone = F.concat(country, _same_shape(F.substring(entity, F.length(country) + 1, F.length(entity)), d))
        plain = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone)
        plain = plain.when(kind == "name", _person(entity, d)).otherwise(_same_shape(entity, d))
        # a domain that is used up grows
        return F.when(attempt < ATTEMPTS, plain).otherwise(F.concat(plain, F.substring(F.translate(d, "abcdef", "012345"), 1, 8)))

    return let(F.sha2(F.concat_ws("|", F.lit(key), kind, entity, attempt.cast("string")).cast("binary"), 256), drawn)


def surrogate_map(found: DataFrame, scratch: Scratch, key: str = KEY) -> DataFrame:
    """``entity, kind, surrogate`` for the distinct entities of column ``entity``; no two share a surrogate, and none is an entity."""
    every, _ = scratch.write(found.select("entity").distinct().withColumn("kind", entity_type(F.col("entity"))))
    draw = lambda df: df.withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), F.col("attempt"), key))
    mapping, path = scratch.write(draw(every.withColumn("attempt", F.lit(0))))
    real = every.select(F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
    while True:
        # of those that share a surrogate, the one that had it longest stays (smallest attempt, then entity)
        first = mapping.groupBy("surrogate").agg(F.min(F.struct((-F.col("attempt")).alias("a"), "entity")).alias("one"))
        checked = mapping.join(first, "surrogate").join(real, "surrogate", "left")
        bad = (F.col("entity") != F.col("one.entity")) | F.col("real").isNotNull()
        left = checked.select("entity", "kind", "surrogate", F.when(bad, F.col("attempt") + 1).otherwise(F.col("attempt")).alias("attempt"), bad.alias("bad"))
        if not left.where("bad").limit(1).count():
            return mapping.select("entity", "kind", "surrogate")
        again = draw(left.drop("surrogate")).select("entity", "kind", "surrogate", "attempt")
        old = path
        mapping, path = scratch.write(again.select(*mapping.columns))
        scratch.release(old)


def pseudonymize(docs: DataFrame, text_col: str = "text", key: str = KEY, count: str | None = None) -> DataFrame:
    """``docs`` with every detected entity in ``text_col`` replaced, and their number as column ``count`` if named.

    Null and empty texts and texts without entities stay as they are.  Rows,
    ids and other columns are kept; an empty table gives an empty result.
    """
    taken = {"__found", "__digest", "__new"} & {*docs.columns}
    if taken:
        raise ValueError(f"columns {taken} are taken")
    scratch = Scratch(docs.sparkSession, "surrogates")
    text = F.col(f"`{text_col}`")
    own = [F.col(f"`{c}`") for c in docs.columns]
    scanned = docs.withColumn("__found", F.coalesce(entities(text), F.array().cast("array<string>")))
    hits = scanned.where(F.size("__found") > 0)
    texts, _ = scratch.write(hits.select(F.sha2(text.cast("binary"), 256).alias("__digest"), "__found").distinct())
    each = texts.select("__digest", F.posexplode("__found").alias("i", "entity"))
    mapping = surrogate_map(each, scratch, key)
    ordered = each.join(mapping, "entity").groupBy("__digest").agg(F.sort_array(F.collect_list(F.struct("i", "surrogate"))).alias("__new"))
    gaps = F.split(text, PATTERN, -1)
    pieces = F.zip_with(gaps, F.transform("__new", lambda x: x["surrogate"]), lambda g, s: F.concat(g, F.coalesce(s, F.lit(""))))
    # a text is split between the same matches that were extracted
    done = hits.withColumn("__digest", F.sha2(text.cast("binary"), 256)).join(ordered, "__digest").withColumn("__text", F.array_join(pieces, ""))
    many = [F.size("__found").cast("bigint").alias(count)] if count else []
    new = [(F.col("__text") if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns]
    none = [F.lit(0).cast("bigint").alias(count)] if count else []
    return done.select(*new, *many).union(scanned.where(F.size("__found") == 0).select(*own, *none))
