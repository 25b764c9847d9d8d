"""Sharding by a two-pass external shuffle. DataFrame functions only.

The first pass counts how many records a seeded hash deals to each bucket; the second one scatters
the records to their buckets, which are small enough for memory, and puts each bucket in the order
of a Fisher-Yates shuffle. Buckets one after the other are a shuffle of all records, and shards are
stretches of it. Everything follows from the records and the seed: reruns, other partitionings and
tasks that are repeated after a loss give the same shards."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPAN = 4096  # buckets whose counts are summed up by one task
CHUNK = 1 << 16  # copies of a record that are told apart at a time


def hashed(*parts: Column) -> Column:
    """A 60-bit hash of some columns as texts, which other SQL engines can repeat."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def fisher_yates(n: Column, *key: Column) -> Column:
    """A permutation of 0 .. n-1 as an array, by the shuffle from the inside out: element i goes to
    a drawn place j <= i, and what was there to place i. Draws are hashes of the key and i."""
    draws = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.pmod(hashed(*key, i), i + 1).cast("int"))

    def put(a: Column, j: Column) -> Column:
        i = F.size(a)
        moved = F.concat(F.slice(a, F.lit(1), j), F.array(i), F.slice(a, j + 2, i), F.array(F.get(a, j)))
        return F.when(j == i, F.concat(a, F.array(i))).otherwise(moved)

    return F.aggregate(draws, F.array().cast("array<int>"), put)


def _identity(df: DataFrame) -> Column:
    """A text that tells records apart: numbers as they are, everything else by its MD5."""

    def part(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            return c
        return F.md5(c if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.to_json(F.struct(c)))

    return F.to_json(F.struct(*[part(f).alias(f.name) for f in df.schema]), {"ignoreNullFields": "false"})


def _bytes(df: DataFrame) -> Column:
    """About how many bytes a record takes in memory."""
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return sum(texts, F.lit(16 * (1 + len(df.columns)))).cast("long")


def _told_apart(rows: DataFrame) -> DataFrame:
    """(row, id, nth): repeated rows get numbers. Where no two rows have one id, which a shuffle of
    hashes tells, nothing else is shuffled; otherwise equal rows meet as one row with a count."""
    if rows.groupBy(F.xxhash64("id")).count().where("count > 1").isEmpty():
        return rows.withColumn("nth", F.lit(0).cast("long"))
    one = rows.groupBy("id", "row").agg(F.count("*").alias("n"))
    some = one.withColumn("high", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {CHUNK}"))))
    return some.select("row", "id", F.explode(F.sequence(F.col("high") * CHUNK, F.least(F.col("n"), (F.col("high") + 1) * CHUNK) - 1)).alias("nth"))


def _offsets(counts: DataFrame) -> DataFrame:
    """(bucket, before): how many records the buckets before it have. Counts are summed up by spans
    of buckets, so one task sees a row for every 4096 buckets."""
    counts = counts.withColumn("span", F.expr(f"bucket div {SPAN}"))
    within = counts.withColumn("before", F.sum("n").over(Window.partitionBy("span").orderBy("bucket")) - F.col("n"))
    spans = counts.groupBy("span").agg(F.sum("n").alias("n"))
    spans = spans.select("span", (F.sum("n").over(Window.orderBy("span")) - F.col("n")).alias("first"))
    return within.join(spans, "span").select("bucket", (F.col("before") + F.col("first")).alias("before"))


def shuffled(df: DataFrame, shards: int = 24, bucket_rows: int = 1024, bucket_bytes: int = 1 << 26, seed: int = 0) -> DataFrame:
    """df in `shards` shards of random records, whose counts are at most one apart: its columns in
    the struct `row` (so that no name clashes), shard (int) and slot (long, from 0 without gaps).

    A bucket has about bucket_rows records and bucket_bytes bytes. Nulls are values like others,
    repeated rows are all kept and dealt one by one, an empty table gives an empty result. Columns
    may have any type that can be compared, and maps of such."""
    maps = [f.name for f in df.schema if isinstance(f.dataType, T.MapType)]
    entry = lambda c: F.array_sort(F.map_entries(F.col(f"`{c}`"))) if c in maps else F.col(f"`{c}`")
    rows = _told_apart(df.select(F.struct(*[entry(c).alias(c) for c in df.columns]).alias("row"), _identity(df).alias("id")))
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(_bytes(df)), F.lit(0))).first()
    buckets = max(1, math.ceil(n / bucket_rows), math.ceil(size / bucket_bytes))
    rows = rows.withColumn("bucket", F.pmod(hashed(F.lit("scatter"), F.lit(seed), "id", "nth"), F.lit(buckets)))
    before = _offsets(rows.groupBy("bucket").agg(F.count("*").alias("n")))
    # a bucket's offset comes to it as one more record, so records are shuffled once and not joined
    record = F.struct("id", "nth", "row")
    dealt = rows.select("bucket", record.alias("record"), F.lit(None).cast("long").alias("before")).unionByName(before, allowMissingColumns=True)
    bucket = dealt.repartitionByRange("bucket").groupBy("bucket").agg(F.sort_array(F.collect_list("record")).alias("records"), F.max("before").alias("before"))
    order = fisher_yates(F.size("records"), F.lit("order"), F.lit(seed), F.col("bucket"))
    placed = bucket.select("before", F.posexplode(F.transform(order, lambda k: F.get("records", k)["row"])).alias("at", "row"))
    place = F.col("before") + F.col("at")
    shard = F.expr(f"place * {shards} div {n}") if n else F.lit(0)
    placed = placed.select("row", place.alias("place")).withColumn("shard", shard.cast("int"))
    first = F.expr(f"(cast(shard as long) * {n} + {shards - 1}) div {shards}")
    back = F.struct(*[(F.map_from_entries(F.col(f"row.`{c}`")) if c in maps else F.col(f"row.`{c}`")).alias(c) for c in df.columns])
    return placed.select(back.alias("row"), "shard", (F.col("place") - first).alias("slot"))


def write_shards(df: DataFrame, path: str, **options) -> None:
    """The shards of shuffled(df) as Parquet, a folder each; a shard's files, and the rows in them,
    are in the order of their slots. The records are shuffled once: tasks hold stretches of buckets."""
    out = shuffled(df, **options).sortWithinPartitions("shard", "slot")
    out.select("row.*", F.col("shard").alias("__shard")).write.partitionBy("__shard").parquet(path)


def shard_report(docs: DataFrame, shards: int = 24, **options) -> DataFrame:
    """Documents in shards: doc_id, size (UTF-8 bytes of the text and 8), text_crc32 (0 for a null
    text, which has no bytes), law ("rows": counts are at most one apart), shard, slot, grown_shard (null under this law)."""
    text = F.col("row.text")
    return shuffled(docs, shards, **options).select(
        F.col("row.doc_id").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
