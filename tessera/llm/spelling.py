"""Spelling variants by permuterm rotations.

A word ends with a mark and is rotated in every way. A rotation without its last character is a
prefix that skips one character of the word, whichever it is: words that differ in this character
share the prefix, and the prefix is a whole rotation of the word that lacks it. So a replaced
character, an inserted one and a deleted one all are equality in the sorted rotations. A group of
equal prefixes has at most one word for each letter and one word that is shorter, however many
words there are."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

MARK = "$"  # in no word
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LITERAL = 128  # prefixes of more characters stand as hashes, so that a long word's rotations don't grow with its square
_PRIMES = ((1 << 61) - 1, (1 << 59) - 55)
_BASE = 0x1B873593CC9E2D51
KEYS = "key string, id long, n long, skips boolean, starts boolean"


def word_counts(docs: DataFrame, least_length: int = 7, least_count: int = 2, slip: int = 31) -> DataFrame:
    """(word, n): the words of all texts with their occurrences. Words are maximal runs of Latin
    letters (to U+00FF), with A-Z as a-z; those with fewer code points or occurrences are left out.

    Where `slip` divides h, the CRC-32 of "<doc_id>:<word>", the word's code point h mod length is
    missing, as if mistyped (slip=0: nowhere). A null text has no words; a null doc_id counts as
    empty. Repeated rows count again."""
    run = rf"[A-Za-zÀ-ÿ]{{{least_length},}}"  # greedy: what it finds are the maximal runs that are long enough
    word = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(F.regexp_extract_all("text", F.lit(run), F.lit(0))).alias("word"))
    word = word.select("d", F.translate("word", UPPER, LOWER).alias("word"))
    if slip:
        word = word.withColumn("h", F.crc32(F.concat("d", F.lit(":"), "word").cast("binary")))
        at = F.expr("cast(h % length(word) as int)")
        word = word.select(F.when(F.col("h") % slip == 0, F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))).otherwise(F.col("word")).alias("word"))
    return word.groupBy("word").agg(F.count("*").alias("n")).where((F.col("n") >= least_count) & (F.length("word") >= least_length))


def _numbered(words: DataFrame) -> DataFrame:
    """words (word, n), written, with numbers (id) that are in the order of their code points."""
    counted = written(words.select("word", "n"), "counted")
    return written(counted.orderBy("word").withColumn("id", F.monotonically_increasing_id()), "vocabulary")


def _literal_keys(words: DataFrame) -> DataFrame:
    """The prefixes of up to LITERAL characters: skips: it skips a character of the word, which
    `starts` a run of equal ones or not; otherwise it is a whole rotation."""
    size = F.length("word")
    turn = lambda j, skip: F.concat(F.substr(F.col("word"), j + 1 + skip), F.lit(MARK), F.substr(F.col("word"), F.lit(1), j))
    starts = lambda i: (i == 0) | (F.substr(F.col("word"), i + 1, F.lit(1)) != F.substr(F.col("word"), i, F.lit(1)))
    skipping = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(turn(i, 1).alias("key"), F.lit(True).alias("skips"), starts(i).alias("starts")))
    whole = F.transform(F.sequence(F.lit(0), size), lambda j: F.struct(turn(j, 0).alias("key"), F.lit(False).alias("skips"), F.lit(True).alias("starts")))
    keys = F.when(size < LITERAL, F.concat(skipping, whole)).otherwise(skipping)
    return words.where((size > 0) & (size <= LITERAL)).select(F.explode(keys).alias("k"), "id", "n").select("k.key", "id", "n", "k.skips", "k.starts")


def _rotation_hashes(word: str, literal: int) -> Iterator[tuple[str, bool, bool]]:
    """(key, skips, starts) of the prefixes of over `literal` characters, as hashes of 120 bits; each
    follows from hashes of the word's beginnings in a step."""
    size, codes = len(word), [ord(c) + 1 for c in word]
    sides = []
    for p in _PRIMES:
        start, power = [0], [1]
        for c in codes:
            start.append((start[-1] * _BASE + c) % p)
            power.append(power[-1] * _BASE % p)
        power.append(power[-1] * _BASE % p)
        sides.append((p, start, power))

    def key(tail: int, head: int, length: int) -> str:
        """word[tail:] + MARK + word[:head]"""
        found = []
        for p, start, power in sides:
            x = start[size] - start[tail] * power[size - tail]
            found.append(((x * _BASE + ord(MARK) + 1) * power[head] + start[head]) % p)
        return f"#{length}:{found[0]:x}:{found[1]:x}"

    if size > literal:
        for i in range(size):
            yield key(i + 1, i, size), True, i == 0 or word[i] != word[i - 1]
    for j in range(size + 1):
        yield key(j, j, size + 1), False, True


def _hashed_keys(words: DataFrame) -> DataFrame:
    literal = LITERAL

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for word, i, n in zip(batch["word"], batch["id"], batch["n"], strict=True):
                rows: list[tuple] = []
                for found in _rotation_hashes(word, literal):
                    rows.append(found)
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows, columns=["key", "skips", "starts"]).assign(id=i, n=n)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=["key", "skips", "starts"]).assign(id=i, n=n)

    return words.where(F.length("word") >= literal).select("word", "id", "n").mapInPandas(run, KEYS)


def _groups(words: DataFrame) -> DataFrame:
    """Groups of words (id, n) that share a prefix, in the order of all rotations."""
    keys = _literal_keys(words).unionByName(_hashed_keys(words))
    grouped = keys.repartitionByRange("key").groupBy("key").agg(F.collect_list(F.struct("id", "n", "skips", "starts")).alias("g"))
    return grouped.where(F.size("g") > 1)


def _near(m: Column) -> Column:
    """The words of a group that are near its member m. A character of a run of equal ones is
    left out in one way only, at the run's start, so no pair of words comes twice."""
    return F.filter("g", lambda x: (x["id"] != m["id"]) & F.when(x["skips"] & m["skips"], True).otherwise((x["skips"] != m["skips"]) & x["starts"] & m["starts"]))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near): all ordered pairs of words (word, n: distinct words) that differ in exactly one
    inserted, deleted or replaced code point."""
    words = _numbered(words)
    pairs = _groups(words).select(F.explode("g").alias("m"), "g").select("m.id", F.explode(_near(F.col("m"))).alias("near"))
    pairs = pairs.select("id", F.col("near.id").alias("other")).join(words.select("id", "word"), "id")
    return pairs.join(words.select(F.col("id").alias("other"), F.col("word").alias("near")), "other").select("word", "near")


def variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """Each word (word, n) with its form, the most frequent word near it (ties: the first in
    code-point order), if that has `factor` times its occurrences, and its root, the last form of
    its forms' forms (the word itself, if it has none): word, form, root, n, n_near, form_n.

    Words are distinct and not null; an empty table gives an empty result. A form's n grows by the
    factor with every step, so chains are as short as n has digits."""
    words = _numbered(words)
    best = lambda near: F.array_max(F.transform(near, lambda x: F.struct(x["n"].alias("n"), (-x["id"]).alias("id"))))
    seen = _groups(words).select(F.explode("g").alias("m"), "g").select("m.id", _near(F.col("m")).alias("near")).select("id", F.size("near").alias("k"), best(F.col("near")).alias("best"))
    seen = written(seen.where("k > 0").groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best")), "near")
    facts = words.join(seen, "id", "left").withColumn("has", F.coalesce(F.col("best.n") >= factor * F.col("n"), F.lit(False)))
    facts = written(facts.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("has"), -F.col("best.id")).alias("form_id")), "facts")
    roots = facts.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("to"))
    most = facts.agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(max(2, 1 + math.log(most, max(2, factor)))))):  # each round doubles the steps
        roots = written(roots, "roots")
        further = roots.select(F.col("id").alias("to"), F.col("to").alias("next"))
        roots = roots.join(further, "to", "left").select("id", F.coalesce("next", "to").alias("to"))
    named = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    ends = roots.join(words.select(F.col("id").alias("to"), F.col("word").alias("root")), "to").select("id", "root")
    out = facts.join(named, "form_id", "left").join(ends, "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_report(docs: DataFrame) -> DataFrame:
    """variants() of the words of documents."""
    return variants(word_counts(docs))
