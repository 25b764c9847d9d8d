"""N-gram Jaccard join by prefix trees, exact, with connected groups of documents.

Texts become sets of hashed word n-grams, written once. All sets are put in one global order,
n-grams that no other text has first, then by how many texts have them; two sets that are
similar enough share an n-gram in their short prefixes. First every list of a prefix n-gram
links its sets to one of them. What is still apart then meets whole groups: the sets of a part of
a group form a trie, which a set from outside walks. Sets that begin alike share the work of
counting their overlap with it, and a branch is left as soon as the n-grams that remain can't
reach the threshold."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, merged, written
from .words import in_chunks, mixed, shingle_sets

HOT_TOKENS = 1 << 20  # so many of the most frequent n-grams are ordered by frequency: a bound of what is broadcast
FILTER_BITS = 1 << 26  # 8 MB: filters of this size only spare work, what passes is joined exactly
SEGMENT = 64
PART = 1 << 18  # n-grams of a task's sets, about
BUCKET = 1 << 20  # n-grams that are counted together, about
SHORT = np.uint64(20)  # bits of a hash that its count and filters leave out


def _least(n: np.ndarray | int, percent: int):
    """The smallest overlap that a set of n elements can have with a similar one."""
    return -(-n * percent // 100)


def _signature(s: np.ndarray) -> int:
    """A hash of a whole set; of an empty set 0."""
    return int((mixed(s).sum(dtype="uint64") + np.uint64(len(s))).view("int64")) if len(s) else 0


def _sets(n: int):
    """Per text: id, size, signature and the sorted hashes of its set, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in in_chunks(texts):
                sets = shingle_sets(texts[lo:hi], n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array([_signature(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["id", "n", "sig", "set"],
                )

    return run


def _dealt(bits: int):
    """How often n-grams occur in some sets, in 2**bits buckets of shortened hashes: packed hashes and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column(0)).to_numpy())
            cuts = np.unique(np.concatenate([[0], np.searchsorted(size, np.arange(8 * BUCKET, size[-1] + 1, 8 * BUCKET)) + 1, [len(size)]])) if len(size) else []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                token, k = np.unique(np.frombuffer(b"".join(batch.column(0).slice(lo, hi - lo).to_pylist()), "uint64") >> SHORT, return_counts=True)
                bucket = (token >> np.uint64(44 - bits)).astype("int64")
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.append(first[1:], len(token)).tolist()
                low, k = (token & np.uint64(0xFFFFFFFF)).astype("<u4"), np.minimum(k, 65535).astype("<u2")
                packed = [[x[i:j].tobytes() for i, j in zip(first.tolist(), ends, strict=True)] for x in (low, k)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array((token[first] >> np.uint64(32)).astype("int64")), *(pa.array(x, pa.binary()) for x in packed)], ["bucket", "high", "low", "k"])

    return run


def _repeated(rows: pd.DataFrame) -> pd.DataFrame:
    """Shortened hashes of one bucket that occur more than once, with their number."""
    parts = [np.frombuffer(x, "<u4").astype("uint64") | np.uint64(h) << np.uint64(32) for h, x in zip(rows["high"], rows["low"], strict=True)]
    token, at = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([np.frombuffer(x, "<u2") for x in rows["k"]])).astype("int64")
    return pd.DataFrame({"token": token[total > 1].astype("int64"), "k": total[total > 1]})


class _Filter:
    """A bit per hash value of a set of longs; no false negatives."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, x: np.ndarray) -> np.ndarray:
        bit = mixed(x.view("uint64")) % np.uint64(FILTER_BITS)
        return (self.words[(bit >> np.uint64(6)).astype("int64")] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _bits(df: DataFrame, column: str) -> _Filter:
    """A _Filter of a column of longs. Tasks send the words of their bits, which are or-ed
    together, so at most FILTER_BITS / 64 longs reach the driver."""

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = np.zeros(FILTER_BITS // 64, "uint64")
        for batch in batches:
            bit = mixed(batch["x"].to_numpy().astype("int64").view("uint64")) % np.uint64(FILTER_BITS)
            np.bitwise_or.at(words, (bit >> np.uint64(6)).astype("int64"), np.uint64(1) << (bit & np.uint64(63)))
        at = np.flatnonzero(words)
        yield pd.DataFrame({"at": at.astype("int32"), "word": words[at].view("int64")})

    found = df.select(F.col(column).alias("x")).mapInPandas(bits, "at int, word long").groupBy("at").agg(F.bit_or("word").alias("word"))
    words = np.zeros(FILTER_BITS // 64, "uint64")
    for batch in found.toArrow().to_batches():
        words[batch["at"].to_numpy()] = batch["word"].to_numpy().view("uint64")
    return _Filter(words)


def _filter(df: DataFrame, column: str) -> Broadcast:
    """The filter of a column, broadcast; who asks for it destroys it."""
    return df.sparkSession.sparkContext.broadcast(_bits(df, column))


class _Order:
    """The global order: n-grams that occur once, then others by hash, then the most frequent
    ones by class of frequency."""

    def __init__(self, repeated: _Filter, token: np.ndarray, count: np.ndarray):
        at = np.argsort(token)
        self.repeated, self.token, self.rank = repeated, token[at], (2 + np.log2(np.maximum(1, count[at]))).astype("uint8")

    def ranks(self, s: np.ndarray) -> np.ndarray:
        short = s >> SHORT
        rank = self.repeated.has(short).astype("uint8")
        at = np.flatnonzero(rank)
        if len(self.token) and len(at):
            x = short[at]
            place = np.minimum(np.searchsorted(self.token, x), len(self.token) - 1)
            rank[at] = np.where(self.token[place] == x, self.rank[place], 1)
        return rank

    def arranged(self, s: np.ndarray) -> np.ndarray:
        """A sorted set of hashes in global order."""
        return s[np.argsort(self.ranks(s), kind="stable")]


def _ordered(sets: DataFrame) -> Broadcast:
    """The order of all n-grams of the sets. They are counted where their hashes meet, packed;
    the driver gets a filter and the HOT_TOKENS most frequent ones."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    bits = min(40, math.ceil(math.log2(total / BUCKET + 1)))
    counts = sets.where("n > 0").select("set").mapInArrow(_dealt(max(12, bits)), "bucket long, high long, low binary, k binary")
    counts = counts.withColumn("bucket", F.shiftright("bucket", max(0, 12 - bits)))
    counts = written(counts.groupBy("bucket").applyInPandas(_repeated, "token long, k long"), "repeated")
    hot = counts.where("k > 2").orderBy(F.desc("k"), "token").limit(HOT_TOKENS).toArrow()
    order = _Order(_bits(counts, "token"), hot["token"].to_numpy().view("uint64"), hot["k"].to_numpy())
    return sets.sparkSession.sparkContext.broadcast(order)


def _prefix(s: np.ndarray, percent: int) -> np.ndarray:
    """The prefix of a set in global order."""
    return s[: len(s) - _least(len(s), percent) + 1]


def _postings(percent: int, order: Broadcast):
    """n-grams of each set's prefix, if another text may have them, with their place in it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            token, sig, size, place = [], [], [], []
            for x, raw in zip(batch["sig"].tolist(), batch["set"], strict=True):
                s = np.frombuffer(raw, "uint64")
                rank = order.value.ranks(s)
                if (alone := int((rank == 0).sum())) < len(s) - _least(len(s), percent) + 1:
                    p = _prefix(s[np.argsort(rank, kind="stable")], percent)[alone:]
                    token.append(p.view("int64"))
                    place.append(np.arange(alone, alone + len(p)))
                    sig.append(np.full(len(p), x))
                    size.append(np.full(len(p), len(s)))
            if token:
                yield pd.DataFrame({"token": np.concatenate(token), "sig": np.concatenate(sig), "n": np.concatenate(size), "place": np.concatenate(place)})

    return run


def _wanted(order: Broadcast, only: Broadcast):
    """Sets in global order, as big-endian bytes, of signatures that may be wanted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[only.value.has(batch["sig"].to_numpy())]
            if len(batch):
                yield pd.DataFrame({"sig": batch["sig"], "set": [order.value.arranged(np.frombuffer(x, "uint64")).astype(">u8").tobytes() for x in batch["set"]]})

    return run


def overlaps(probe: np.ndarray, members: Iterable[bytes], percent: int) -> Iterator[int]:
    """For sets in global order (big-endian bytes, in ascending order of these): the overlap
    with the probe (sorted), or -1 where the threshold can't be reached.

    Ascending byte strings are a depth-first walk of their trie: what a set shares with the
    one before it is the path that both have in common, whose partial overlaps are kept. Below
    it, the walk goes on a segment at a time and ends when the overlap so far and the rest of
    the shorter side can't reach the overlap that the sizes call for. A branch that was left on
    the common path is left for the next set too."""
    before, counts, left = np.zeros(0, ">u8"), np.zeros(1, "int64"), 0
    for raw in members:
        s = np.frombuffer(raw, ">u8")
        need = -(-percent * (len(s) + len(probe)) // (100 + percent))
        m = min(len(s), len(before), left)
        differ = np.flatnonzero(s[:m] != before[:m])
        depth = int(differ[0]) if len(differ) else m
        total = np.zeros(len(s) + 1, "int64")
        total[: depth + 1] = counts[: depth + 1]
        at, have = depth, int(total[depth])
        step = SEGMENT
        while at < len(s) and have + min(len(s) - at, len(probe) - have) >= need:
            part = s[at : at + step].astype("uint64")
            hit = probe[np.minimum(np.searchsorted(probe, part), len(probe) - 1)] == part
            np.cumsum(hit, out=total[at + 1 : at + 1 + len(part)])
            total[at + 1 : at + 1 + len(part)] += have
            at += len(part)
            have = int(total[at])
            step *= 2
        yield have if at == len(s) and have >= need else -1
        before, counts, left = s, total, at


def _walked(percent: int):
    """Similar pairs (probe, member) in one task: members of a cell stand in its trie, and each
    probe walks it along those that share an n-gram of the prefixes with it and come later in the
    order of groups. One link with a group is enough, as the group is connected."""

    def run(members: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        asked = dict(iter(probes.drop_duplicates(["cell", "sig"]).groupby("cell"))) if len(probes) else {}
        for cell, rows in members.groupby("cell") if asked else ():
            if cell not in asked:
                continue
            rows = rows.drop_duplicates("sig").sort_values("set")
            sigs, sets, group, size = rows["sig"].to_numpy(), rows["set"].tolist(), rows["g"].to_numpy(), rows["size"].to_numpy()
            n = np.array([len(x) // 8 for x in sets])
            heads = [_prefix(np.frombuffer(x, ">u8"), percent) for x in sets]
            token, owner = np.concatenate(heads).astype("uint64"), np.repeat(np.arange(len(sets)), [len(x) for x in heads])
            by = np.argsort(token, kind="stable")
            token, owner = token[by], owner[by]
            for x, g, own, raw in asked[cell][["sig", "g", "size", "set"]].itertuples(index=False):
                s = np.frombuffer(raw, ">u8").astype("uint64")
                head = _prefix(s, percent)
                lo, hi = np.searchsorted(token, head), np.searchsorted(token, head, side="right")
                hit = np.flatnonzero(hi > lo)
                near = np.unique(np.concatenate([owner[lo[i] : hi[i]] for i in hit])) if len(hit) else hit
                near = near[(100 * np.minimum(n[near], len(s)) >= percent * np.maximum(n[near], len(s))) & ((size[near] > own) | ((size[near] == own) & (group[near] > g)))]
                done, now = set(), []

                def left(near=near, done=done, now=now, group=group, sets=sets) -> Iterator[bytes]:
                    for i in near.tolist():
                        if group[i] not in done:
                            now.append(i)
                            yield sets[i]

                for have in overlaps(np.sort(s), left(), percent):
                    if have >= 0:
                        a.append(x)
                        b.append(sigs[now[-1]])
                        done.add(group[now[-1]])
        return pd.DataFrame({"a": np.array(a, "int64"), "b": np.array(b, "int64")})

    return run


def _links(members: DataFrame, probes: DataFrame, sets: DataFrame, order: Broadcast, percent: int, name: str) -> DataFrame:
    """Links (a, b) of probes with members of their cells, where the member's group is the later
    one by (size, g). Both are (cell, sig, n, g, size). A cell is dealt into parts of about PART
    n-grams, parts go to buckets, and a bucket's probes are dealt into slices: no task holds a
    whole cell, or all that ask for it."""
    members, probes = written(members, f"{name}-members"), written(probes, f"{name}-probes")
    parts = members.groupBy("cell").agg(F.ceil(F.sum(F.col("n") + 64) / PART).cast("int").alias("parts"), F.sum(F.col("n") + 64).alias("total"))
    parts = written(parts, f"{name}-sizes")
    count = max(1, math.ceil((parts.agg(F.sum("total")).first()[0] or 0) / PART))
    bucket, parts = F.pmod(F.xxhash64("cell", "part"), F.lit(count)).alias("bucket"), parts.select("cell", "parts")
    asked = probes.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("*", bucket)
    slices = written(asked.groupBy("bucket").agg(F.ceil(F.sum(F.col("n") + 64) / PART).cast("int").alias("slices")), f"{name}-slices")
    asked = asked.join(slices, "bucket").withColumn("slice", F.pmod(F.xxhash64("sig"), "slices").cast("int"))
    held = members.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("sig"), "parts").cast("int")).select("*", bucket)
    held = held.join(slices, "bucket").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    wanted = _filter(members.select("sig").union(probes.select("sig")), "sig")
    known = sets.where("n > 0").select("sig", "set").mapInPandas(_wanted(order, wanted), "sig long, set binary")
    known = written(known.groupBy("sig").agg(F.first("set").alias("set")), f"{name}-sets")  # copies of a text have the same set
    wanted.destroy()
    key, rest = ["bucket", "slice"], ["cell", "g", "size", "sig", "set"]
    again = known.select(F.col("sig").alias("sig"), F.col("set").alias("set"))
    held = held.join(known, "sig").select(*key, *rest)
    asked = asked.join(again, "sig").select(*[F.col(c).alias(c) for c in (*key, *rest)])
    found = held.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(_walked(percent), "a long, b long")
    return written(found, f"{name}-links")


def _fits(a: str, b: str, percent: int) -> Column:
    """Two sets of sizes n can be similar, given the places of a shared n-gram in their order."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    rest = F.least(x - F.col(f"{a}.place"), y - F.col(f"{b}.place"))
    return (100 * F.least(x, y) >= percent * F.greatest(x, y)) & (rest * (100 + percent) >= percent * (x + y))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """Connected groups of documents whose n-word shingle sets have a Jaccard similarity of at
    least percent / 100; no link between groups is lost.

    Words are lower-cased in A-Z. Fewer than n words count as one shingle, no words (or null)
    give an empty set, which is linked with nothing. Texts of equal sets are one vertex,
    whatever their number. First, every list of a shared prefix n-gram links its sets to one of
    them (as many candidates as postings). Then groups that still share prefix n-grams stand in
    cells, each in that of its longest list, and the sets of smaller groups that meet a cell in a list
    walk its tries, so neither near copies nor sets that are nearly similar become rows of all
    their pairs.

    Returns id_col, n_shingles, component_id (the smallest id of its group, itself included) for
    every row; rows of one id are one document, a null id has a null component.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = written(texts.mapInArrow(_sets(n), "id long, n long, sig long, set binary"), "sets")
    rows = sets.select("id", "n", "sig")
    sets = sets.where("id IS NOT NULL")
    order = _ordered(sets)

    posts = sets.where("n > 0").select("sig", "set").mapInPandas(_postings(percent, order), "token long, sig long, n long, place long").distinct()
    posts = written(posts, "prefixes")
    shared = posts.groupBy("token").agg(F.min("sig").alias("low"), F.max("sig").alias("high")).where("low < high").select("token")
    posts = written(posts.join(shared, "token", "left_semi"), "postings")

    first = posts.groupBy("token").agg(F.min(F.struct("sig", "n", "place")).alias("f")).select("token", "f.*")
    stars = posts.alias("x").join(first.alias("f"), "token").where((F.col("x.sig") != F.col("f.sig")) & _fits("x", "f", percent))
    # Of the sets that a set meets so, the one of most n-grams: near copies have many in common.
    stars = stars.groupBy(F.col("x.sig").alias("sig"), F.col("f.sig").alias("g"), F.col("x.n").alias("n"), F.col("f.n").alias("m")).agg(F.count("*").alias("both"))
    stars = written(stars.groupBy("sig", "n").agg(F.max(F.struct("both", "g", "m")).alias("m")).select("m.g", "sig", "n", "m.m"), "stars")
    one = lambda n: F.lit(n).cast("long").alias("size")
    members = stars.select(F.col("g").alias("cell"), "sig", "n", F.col("sig").alias("g"), one(1))
    probes = stars.select(F.col("g").alias("cell"), F.col("g").alias("sig"), F.col("m").alias("n"), "g", one(0)).distinct()
    groups = components(_links(members, probes, sets, order, percent, "star"))

    label = posts.join(groups.withColumnRenamed("id", "sig"), "sig", "left").withColumn("g", F.coalesce("component", "sig")).drop("component")
    apart = label.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high"), F.count("*").alias("long")).where("low < high").select("token", "long")
    label = written(label.join(apart, "token"), "open")
    size = label.select("g", "sig").distinct().groupBy("g").agg(F.count("*").alias("size"))
    cells = label.groupBy("g").agg(F.max(F.struct("long", "token")).alias("m")).select("g", F.col("m.token").alias("cell"))
    label = written(label.join(size.join(cells, "g"), "g"), "cells")
    later = F.struct("size", "g")
    lists = label.groupBy("token", "cell").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("place")).alias("rest"), F.max(later).alias("last"))
    x, y = label.alias("x"), lists.alias("y")
    can = (100 * F.col("x.n") >= percent * F.col("y.least")) & (100 * F.col("y.most") >= percent * F.col("x.n"))
    can &= F.least(F.col("x.n") - F.col("x.place"), F.col("y.rest")) * (100 + percent) >= percent * (F.col("x.n") + F.greatest("y.least", F.ceil(F.col("x.n") * percent / 100)))
    before = F.struct("x.size", "x.g") < F.col("y.last")
    probes = x.join(y, (F.col("x.token") == F.col("y.token")) & before & can).select(F.col("y.cell").alias("cell"), F.col("x.sig").alias("sig"), F.col("x.n").alias("n"), F.col("x.g").alias("g"), F.col("x.size").alias("size")).distinct()
    probes = written(probes, "between")
    # Rows of one id are one document, so their texts' sets belong together.
    several = rows.where("n > 0 AND id IS NOT NULL").groupBy("id").agg(F.min("sig").alias("a"), F.max("sig").alias("b")).where("a < b")
    more = rows.where("n > 0").join(several, "id").where("sig <> a").select("a", F.col("sig").alias("b"))
    if not probes.isEmpty():
        members = label.select("cell", "sig", "n", "g", "size").distinct().join(probes.select("cell").distinct(), "cell", "left_semi")
        more = more.union(_links(members, probes, sets, order, percent, "between"))
    more = written(more, "more")
    order.destroy()
    groups = groups if more.isEmpty() else merged(groups, more)

    # From sets to documents: the smallest id of a set, then of its group.
    least = rows.where("n > 0 AND id IS NOT NULL").groupBy("sig").agg(F.min("id").alias("least")).join(groups.withColumnRenamed("id", "sig"), "sig", "left").withColumn("g", F.coalesce("component", "sig"))
    least = written(least.select("sig", "g", "least"), "least")
    group = least.groupBy("g").agg(F.min("least").alias("component_id"))
    out = rows.join(least.join(group, "g").select("sig", "component_id"), "sig", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """docs with one document of each group: the row that has the group's smallest id. Of rows
    that share this id one stays, that of the smallest hash of its columns; rows with a null
    id all stay."""
    groups = jaccard_groups(docs, id_col, **options).where(F.col(id_col).isNotNull())
    marks = groups.groupBy(id_col).agg(F.max(F.col(id_col) != F.col("component_id")).alias("__gone"), (F.count("*") > 1).alias("__many"))
    marks = written(marks.where("__gone OR __many"), "marks")
    out = docs.join(marks, id_col, "left_anti")
    if marks.where("NOT __gone").isEmpty():
        return out
    several = docs.join(marks.where("NOT __gone").select(id_col), id_col, "left_semi")
    one = several.groupBy(id_col).agg(F.min(F.struct(F.xxhash64(*several.columns).alias("__hash"), *several.columns)).alias("__row"))
    return out.union(one.select(*[F.col(f"__row.{c}") for c in docs.columns]))
