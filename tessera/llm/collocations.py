"""Collocations by vertical partitioning of a suffix tree over words.

A phrase is a path from the root of the tree of all suffixes, cut off at the longest phrase's
length; how often it occurs is the total of the leaves below it. The tree doesn't fit a task, so
it is cut by prefixes: prefixes (words) are counted first, those with more suffixes than a group's
budget allows are extended by a word until theirs fit, and prefixes are packed into groups. A
group's subtree is built by one task from the suffixes that begin with its prefixes.

Suffixes are cut before a pair of words that occurs too rarely to be part of any phrase, which a
filter of pairs tells (it may let rare ones pass and never stops a frequent one)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .jaccard import _filter
from .words import Words, in_chunks, mixed

CHUNK = 1 << 22  # characters of texts that are counted together before Spark sees them
BUDGET = 1 << 18  # occurrences of suffixes in a group, about
MAX_HEAVY = 1 << 22  # prefixes that are extended: 8 bytes each go to every task
PARTS = 64  # a language's phrases are ranked in so many parts first
UNKNOWN = "und"

# 0: part of a word, 1: space or tab, 2: ends a piece
_KIND = np.zeros(256, "uint8")
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype="uint8")
_LOWER[65:91] += 32


class _Chunk:
    """Words of some texts: lower-case bytes, spans, and for each word a hash of it with its
    language, its text, and whether the next word stands in the same piece."""

    def __init__(self, texts: list[str | None], langs: list[str | None]):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        data = _LOWER[np.frombuffer(b"\n".join([*raw, b""]), "uint8")]
        kind = _KIND[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], kind > 0, [True]]).astype("int8")))
        self.start, self.end = edge[::2], edge[1::2]
        self.doc = np.searchsorted(np.cumsum([len(x) + 1 for x in raw]), self.start, side="right")
        self.langs = [UNKNOWN if x is None else x for x in langs]
        salt = {x: int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") for x in set(self.langs)}
        of_doc = np.array([salt[x] for x in self.langs], "uint64") if self.langs else np.zeros(0, "uint64")
        self.hash = mixed(Words(data, self.doc, self.start, self.end, self.doc).hashes() + of_doc[self.doc])
        piece = np.cumsum(kind == 2)[self.start] if len(self.start) else np.zeros(0, "int64")
        self.joined = np.append(piece[1:] == piece[:-1], False) if len(piece) else np.zeros(0, bool)
        self.bytes = data.tobytes()

    def lang(self, at: np.ndarray) -> pa.Array:
        return pa.array([self.langs[d] for d in self.doc[at].tolist()], pa.string())

    def phrases(self, at: np.ndarray, words: np.ndarray | int) -> pa.Array:
        """The phrases of some words from word `at` on, with a space between words."""
        first, last = self.start[at].tolist(), self.end[at + words - 1].tolist()
        found = [self.bytes[i:j] for i, j in zip(first, last, strict=True)]
        if np.any(words != 1):
            found = [b" ".join(x.replace(b"\t", b" ").split(b" ")) if b"\t" in x else x for x in found]
            found = [b" ".join(filter(None, x.split(b" "))) if b"  " in x else x for x in found]
        return pa.array(found, pa.binary()).cast(pa.string())


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo, hi in in_chunks(texts, CHUNK):
            yield _Chunk(texts[lo:hi], langs[lo:hi])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in _chunks(batches):
        found, at, n = np.unique(c.hash, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([c.lang(at), c.phrases(at, 1), pa.array(found.view("int64")), pa.array(n.astype("int64"))], ["lang", "phrase", "hash", "n"])


def _pair_hashes(c: _Chunk) -> np.ndarray:
    """A hash of every word with the next one."""
    return mixed(c.hash[:-1] + mixed(c.hash[1:] + np.uint64(1))) if len(c.hash) > 1 else np.zeros(0, "uint64")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in _chunks(batches):
        found, n = np.unique(_pair_hashes(c)[c.joined[:-1]], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view("int64")), pa.array(n.astype("int64"))], ["hash", "n"])


def _in(sorted_set: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(x), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, x), len(sorted_set) - 1)] == x


def _suffixes(frequent: Broadcast, heavy: Broadcast, groups: int, longest: int):
    """Suffixes of at least two words, cut off, with the group of their prefix; `shared` where the
    prefix has more than two words, so that other groups have suffixes with the same first two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy_words, heavy_pairs = heavy.value
        for c in _chunks(batches):
            pair = _pair_hashes(c)
            on = c.joined[:-1] & frequent.value.has(pair) if len(pair) else np.zeros(0, bool)
            at = np.flatnonzero(on)
            if not len(at):
                continue
            depth, going = np.full(len(at), 2), np.ones(len(at), bool)
            third = np.zeros(len(at), "uint64")
            leaf = pair[at].copy()
            for k in range(2, longest):
                next_pair = np.minimum(at + k - 1, len(on) - 1)
                going &= (at + k - 1 < len(on)) & on[next_pair]
                depth[going] = k + 1
                word = c.hash[np.minimum(at + k, len(c.hash) - 1)]
                leaf = np.where(going, mixed(leaf + word + np.uint64(k)), leaf)
                if k == 2:
                    third = np.where(going, leaf, third)
            long1 = _in(heavy_words, c.hash[at])
            long2 = long1 & _in(heavy_pairs, pair[at])
            prefix = np.where(long2, mixed(pair[at] + third), np.where(long1, pair[at], c.hash[at]))
            _, first, n = np.unique(leaf, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array((mixed(prefix[first]) % np.uint64(groups)).astype("int64")), c.lang(at[first]), c.phrases(at[first], depth[first]), pa.array(n.astype("int64")), pa.array(long2[first])],
                ["group", "lang", "phrase", "n", "shared"],
            )

    return run


def subtree(leaves: pa.Table, least: int, longest: int) -> pa.Table:
    """The nodes of two to `longest` words of a group's subtree: (lang, phrase, words, n), from its
    leaves (lang, phrase, n, shared); those with less than `least` are left out, but for nodes of two
    words that other groups share. A leaf is a suffix that ends there; equal ones are added up."""
    leaves = leaves.group_by(["lang", "phrase", "shared"]).aggregate([("n", "sum")])
    parts = pc.split_pattern(leaves["phrase"].combine_chunks(), " ")
    length = pc.list_value_length(parts).to_numpy()
    word = pc.list_flatten(parts).dictionary_encode()
    row = np.repeat(np.arange(len(length)), length)
    path = np.full((len(length), 1 + longest), -1, "int64")
    path[:, 0] = leaves["lang"].combine_chunks().dictionary_encode().indices.to_numpy()
    path[row, 1 + np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)] = word.indices.to_numpy()
    order = np.lexsort(path.T[::-1])
    path, length, n = path[order], length[order], leaves["n_sum"].to_numpy()[order]
    shared = leaves["shared"].to_numpy()[order]
    change = np.concatenate([[True], np.zeros(max(0, len(path) - 1), bool)])[: len(path)]
    out = []
    for depth in range(0, longest + 1):
        change[1:] |= path[1:, depth] != path[:-1, depth]
        if depth < 2 or not len(path):
            continue
        first = np.flatnonzero(change)
        total = np.add.reduceat(n, first)
        keep = (length[first] >= depth) & ((total >= least) | (shared[first] & (depth == 2)))
        at = first[keep]
        lang, phrase = leaves["lang"].take(pa.array(order[at])), leaves["phrase"].take(pa.array(order[at]))
        if depth < longest:
            phrase = pa.array([" ".join(x.split(" ")[:depth]) for x in phrase.to_pylist()], pa.string())
        out.append(pa.table({"lang": lang, "phrase": phrase, "words": pa.array(np.full(len(at), depth, "int32")), "n": pa.array(total[keep])}))
    return pa.concat_tables(out) if out else pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string()), "words": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): lang, phrase, n of all words; lang, phrase, words, n of the phrases of two
    to `longest` words with at least `least` occurrences. Words stand in pieces between
    `.,;:!?` and line ends, apart by spaces and tabs, with A-Z as a-z; occurrences may overlap, in
    one piece. A null lang is "und"; a null text has no words; repeated rows count again. Words
    are told apart by 64-bit hashes within about 4 MB of text, and as texts between those."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    words = texts.mapInArrow(_words, "lang string, phrase string, hash long, n long").groupBy("lang", "phrase").agg(F.first("hash").alias("hash"), F.sum("n").alias("n"))
    words = written(words, "words")
    pairs = texts.mapInArrow(_pairs, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    pairs = written(pairs, "pairs")
    total = words.agg(F.sum("n")).first()[0] or 0
    # a prefix of at most an eighth of the budget is packed by its hash, so that groups come near their mean
    most = max(1, budget // 8, 2 * total // MAX_HEAVY)
    heavy = [np.sort(t.where(F.col("n") > most).select("hash").toArrow()["hash"].to_numpy().view("uint64")) for t in (words, pairs)]
    sent, frequent = spark.sparkContext.broadcast(heavy), _filter(pairs, "hash")
    suffixes = texts.mapInArrow(_suffixes(frequent, sent, max(1, -(-total // budget)), longest), "group long, lang string, phrase string, n long, shared boolean")
    nodes = suffixes.groupBy("group").applyInArrow(lambda t: subtree(t.drop_columns(["group"]), least, longest), "lang string, phrase string, words int, n long")
    phrases = written(nodes.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "phrases")
    frequent.destroy()
    sent.destroy()
    return words.select("lang", "phrase", "n"), phrases


def _part(words: str, first: str, count: str) -> F.Column:
    return F.array_join(F.slice(F.col(words), F.expr(first), F.expr(count)), " ")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, covered: int = 50, top: int = 2000, budget: int = BUDGET) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase with a occurrences is cut after its first k words into parts with l and r; its score is
    floor(1000000 a a / (l r)) for the cut with the smallest one (ties: the smallest k), in exact
    decimals. Phrases that stand in a longer one with at least `covered` percent of their
    occurrences are left out. Order: score and a descending, phrase ascending by its bytes.
    n: all words of the language. No rows for an empty table."""
    words, phrases = phrase_counts(docs, longest, least, budget)
    counts = words.where(F.col("n") >= least).unionByName(phrases.select("lang", "phrase", "n"))
    # a longer phrase that covers one by more words has a phrase between them that covers it too
    tail, head = _part("w", "2", "size(w) - 1"), _part("w", "1", "size(w) - 1")
    longer = phrases.where("words > 2").withColumn("w", F.split("phrase", " ")).select("lang", F.explode(F.array(head, tail)).alias("phrase"), "n")
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("above"))
    kept = phrases.join(longer, ["lang", "phrase"], "left").where(F.col("above").isNull() | (100 * F.col("above") < covered * F.col("n"))).drop("above")
    cuts = kept.withColumn("w", F.split("phrase", " ")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("n").alias("a"), "k", _part("w", "1", "k").alias("first"), _part("w", "k + 1", "size(w)").alias("rest"))
    side = lambda part, name: counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
    cuts = cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"])
    big = lambda c: f"cast({c} as decimal(15, 0))"
    cuts = cuts.withColumn("score", F.expr(f"cast(1000000 as decimal(7, 0)) * ({big('a')} * {big('a')}) div ({big('l')} * {big('r')})"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")
    first = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("rank", rank("lang", "part")).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", rank("lang")).where(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
