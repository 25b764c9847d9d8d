"""Mixing sources to target weights: fixed-length token blocks, multinomial counts per
output shard, and a join of blocks by permuted index. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

#: Up to so many sources, the table of their intervals is broadcast (about 100 bytes a source).
BROADCAST_SOURCES = 10_000
GRID, ROUNDS = 1024, 12


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """The place of x in a keyed pseudorandom permutation of 0 .. n-1: a swap-or-not
    shuffle, in which each round maps the pairs x and K-x (mod n) onto themselves. It is
    one-to-one for any n, without tables and without walking."""

    def turn(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(1), r, *key), n) - at, n)
        return F.when(F.xxhash64(F.lit(2), r, F.greatest(at, partner), *key) % 2 == 0, partner).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), turn)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with __key, which is the same in every run: doc_id, source and a hash of the
    text. Null fields are equal to each other in it."""
    return docs.withColumn("__key", F.struct(F.col("doc_id"), F.col("source"), F.xxhash64("text").alias("hash")))


def nth_of_key() -> Column:
    """Tells rows of one key apart, which are repeated rows."""
    return F.row_number().over(Window.partitionBy("__key").orderBy(F.lit(0)))


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """A row per source (sid, source, docs, source_size, target): shares by weight of
    share * all sizes; no target is above cap * its source's size, and what is above goes to
    the others by weight until none is. Sources that reach their cap are those with the
    smallest cap per weight, so the level follows from running sums in that order: it is the
    one of the first source that stays below its cap, and later ones give smaller values."""
    every = Window.partitionBy()
    per = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    per = per.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    per = per.withColumns({"weight": weight, "most": F.col("source_size") * F.lit(float(cap))}).withColumn("ratio", F.col("most") / F.col("weight"))
    before = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    per = per.withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), zero)) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), zero)))
    per = per.withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(every))
    return per.select("sid", "source", "docs", "source_size", F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least("most", F.col("level") * F.col("weight"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, block: int = 64, shard_slots: int = 4096, seed: int = 11, bucket_docs: int = 250) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Draws a mix of the sources of `docs` (which has doc_id, text and source).

    Words are maximal runs without white space; a null text has none, a null source is a
    source. Documents of a source are dealt into buckets of about `bucket_docs`; in each
    bucket the words of all documents, in row order, are packed into blocks of `block` words
    (the last may be shorter). A source's quota of blocks is its target in blocks. Every
    output shard of `shard_slots` slots draws multinomial counts with the quotas as weights;
    a source's slots are numbered through all shards, slots above its quota are left out
    and a closing shard adds what is missing. Slot k reads block perm(k mod n) of its n
    blocks, with another permutation for every pass k div n, so no block is read more than
    `cap` times (rounded up). Everything follows from hashes: reruns agree.

    Returns (sizes, sources, pieces): sizes has __row (key and number among equal keys), sid, size; sources has sid, source,
    source_size, target; pieces has shard, sid, pass, block, __row, first, last: words
    first .. last-1 of a document, read by that shard.
    """
    spark = docs.sparkSession
    sizes = keyed(docs.select("doc_id", "source", "text")).select("__key", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sizes = written(sizes.select(F.struct("__key", nth_of_key().alias("n")).alias("__row"), "source", "size"), "sizes")
    sources = written(targets(sizes, weights, share, cap), "sources")
    buckets = F.pmod(F.xxhash64("__row"), F.ceil(F.col("docs") / bucket_docs)).alias("bucket")
    s, t = sizes.alias("s"), sources.alias("t")
    placed = s.join(t, F.col("s.source").eqNullSafe(F.col("t.source"))).select("s.__row", "t.sid", "s.size", buckets)
    stream = Window.partitionBy("sid", "bucket").orderBy("__row")
    placed = written(placed.withColumn("at", F.sum("size").over(stream) - F.col("size")), "placed")
    per_bucket = placed.groupBy("sid", "bucket").agg(F.ceil(F.sum("size") / block).alias("n"))
    per_bucket = per_bucket.withColumn("base", F.sum("n").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("n"))
    per_bucket = written(per_bucket, "buckets")
    blocks = per_bucket.groupBy("sid").agg(F.sum("n").alias("n"))
    quota = F.least(F.round(F.col("target") * F.col("n") / F.col("source_size")), F.ceil(F.col("n") * cap)).cast("long")
    drawn = sources.where("source_size > 0").join(blocks, "sid").withColumn("quota", quota)
    drawn = written(drawn.withColumn("high", F.sum("quota").over(Window.orderBy("sid"))).withColumn("low", F.col("high") - F.col("quota")), "quotas")
    total, count = drawn.agg(F.coalesce(F.sum("quota"), F.lit(0)), F.count("*")).first()
    slots, wide = max(1, total), max(shard_slots, math.ceil(total / 20_000))

    cell = lambda u: F.floor(u * GRID / slots).cast("long")
    cells = drawn.where("quota > 0").select("sid", "low", "high", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high") - 1))).alias("cell"))
    draws = spark.range(total).select(F.expr(f"id div {wide}").alias("shard"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(slots)).alias("u")).withColumn("cell", cell(F.col("u")))
    draws = draws.join(F.broadcast(cells) if count <= BROADCAST_SOURCES else cells, "cell").where("low <= u AND u < high")
    counts = written(draws.groupBy("shard", "sid").agg(F.count("*").alias("k")), "counts")
    closing = drawn.join(counts.groupBy("sid").agg(F.sum("k").alias("had")), "sid", "left").select(F.lit(math.ceil(slots / wide)).cast("long").alias("shard"), "sid", F.greatest(F.lit(0), F.col("quota") - F.coalesce("had", F.lit(0))).alias("k"))
    counts = counts.union(closing).withColumn("base", F.sum("k").over(Window.partitionBy("sid").orderBy("shard")) - F.col("k"))
    counts = counts.join(drawn.select("sid", "n", "quota"), "sid").withColumn("k", F.least("k", F.col("quota") - F.col("base"))).where("k > 0")
    counts = counts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard", "sid")  # few rows, but each becomes many slots
    slot = counts.select("shard", "sid", "n", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("k") - 1)).alias("slot"))
    slot = slot.withColumn("pass", F.expr("slot div n"))
    slot = slot.select("shard", "sid", "pass", permuted(F.col("slot") % F.col("n"), F.col("n"), F.lit(seed), F.col("sid"), F.col("pass")).alias("block"))

    first, end = F.col("at"), F.col("at") + F.col("size")
    held = placed.where("size > 0").join(per_bucket.select("sid", "bucket", "base"), ["sid", "bucket"])
    held = held.select("sid", "base", "__row", "at", "size", F.explode(F.sequence(F.expr(f"at div {block}"), F.expr(f"(at + size - 1) div {block}"))).alias("b"))
    held = held.select("sid", (F.col("base") + F.col("b")).alias("block"), "__row", (F.greatest(first, F.col("b") * block) - first).alias("first"), (F.least(end, (F.col("b") + 1) * block) - first).alias("last"))
    # counts are few rows, slots aren't: Spark takes these to be as small and would broadcast them by way of the driver
    return placed.select("__row", "sid", "size"), sources, slot.hint("merge").join(held, ["sid", "block"])


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """A row per document: doc_id, size, source_size, target (its source's) and taken (the
    words that the mix reads from it, repeats counted). An empty table gives none."""
    sizes, sources, pieces = mix(docs, **options)
    taken = pieces.groupBy("__row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    facts = sizes.join(taken, "__row", "left").join(sources.select("sid", "source_size", "target"), "sid")
    return facts.select("__row.__key.doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents with the columns of docs: for each pass over its source, a
    document with what that pass read of it. Where a pass read all words, the text is the
    document's own; otherwise it is the words read, in their order, with the white space
    that followed them. n_chars, if there is such a column, becomes the text's length."""
    sizes, _, pieces = mix(docs, **options)
    read = pieces.groupBy("__row", "pass").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("read"))  # as many as the document has blocks
    whole = F.aggregate("read", F.lit(0).cast("long"), lambda n, p: n + p["last"] - p["first"]) == F.col("size")
    read = read.join(sizes.select("__row", "size"), "__row").select("__row.__key", F.struct("__row.n", whole.alias("whole"), "read").alias("r"))
    read = read.groupBy("__key").agg(F.collect_list("r").alias("__reads"))  # a few for each repeated row
    words = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    part = F.array_join(F.flatten(F.transform("__r.read", lambda p: F.slice("__words", (p["first"] + 1).cast("int"), (p["last"] - p["first"]).cast("int")))), "")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")  # the caller's columns, whatever their names
    out = keyed(docs.select("doc_id", "source", "text", row)).join(read, "__key").withColumn("__n", nth_of_key())
    out = out.withColumn("__r", F.explode(F.filter("__reads", lambda r: r["n"] == F.col("__n")))).withColumn("__words", F.when(~F.col("__r.whole"), words))
    out = out.withColumn("text", F.when(F.col("__r.whole"), F.col("text")).otherwise(part))
    new = {"text": F.col("text")} | ({"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return out.select(*[new.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])
