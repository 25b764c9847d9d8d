"""What the operators of this subpackage share: tables cut from their lineage in
the shared folder, and connected components by DataFrame joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words everywhere here: space and \t\n\v\f\r.
WORD = r"[^\x20\x09-\x0D]+"
_made: list[str] = []  # paths of the tables that written() has made in this process
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # shuffle files go when their query ends, not with the driver's garbage
HUB = 256  # a vertex with fewer edges is never a hub


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is
    unset, one is made, but only for a local master (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def _saved(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: later steps neither compute it
    again nor lose it with an executor."""
    return _saved(df, name)[0]


def removed(spark: SparkSession, path: str | None) -> None:
    """Deletes a table of the shared folder that nothing reads any more."""
    if path:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def tables_made(since: int = 0) -> list[str]:
    """Paths of the tables cut from their lineage so far, from the `since`-th on."""
    return _made[since:]


def _with_least(edges: DataFrame, count: int) -> DataFrame:
    """The edges (a, b), each with the smallest b of its a as m. What hubs have is broadcast: a
    hub has over a thousandth of the edges, so there are 1000 at most. Other vertices have few
    edges, so the join by vertex is even."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    limit = max(HUB, count // 1000)
    if count <= limit:
        return edges.join(least.drop("n"), "a")
    hubs = F.broadcast(least.where(F.col("n") > limit).drop("n"))
    return edges.join(hubs, "a").union(edges.join(hubs.select("a"), "a", "left_anti").join(least.drop("n"), "a"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges (a, b) of longs.

    Large-star and small-star steps alternate until every edge joins a vertex to the
    smallest vertex of its component: until no vertex has two smaller neighbours, or a
    smaller and a larger one. Null ends and loops are left out. Returns (id, component)
    for every vertex that has an edge.
    """
    spark = edges.sparkSession
    now = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, path = _saved(now, "edges")
    for _ in range(max_rounds):
        ends = now.select("a", F.lit(1).alias("down"), F.lit(0).alias("up")).union(now.select("b", F.lit(0), F.lit(1)))
        if ends.groupBy("a").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down + up > 1 AND down > 0").isEmpty():
            break
        count = now.count()
        both = _with_least(now.union(now.select("b", "a")), 2 * count)
        large, middle = _saved(both.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct(), "edges")
        both = _with_least(large, count)
        small = both.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(both.select("a", "m")).distinct()
        before = path
        now, path = _saved(small, "edges")
        removed(spark, before)
        removed(spark, middle)
    else:
        raise RuntimeError(f"no end after {max_rounds} rounds")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """groups (id, component) with further links (a, b) taken in: only the links between
    different groups go through components()."""
    side = lambda c: groups.select(F.col("id").alias(c), F.col("component").alias(f"{c}_group"))
    label = links.join(side("a"), "a", "left").join(side("b"), "b", "left").select("a", "b", F.coalesce("a_group", "a").alias("x"), F.coalesce("b_group", "b").alias("y"))
    label = written(label, "between")
    known = written(groups.union(label.select("x", "x")).union(label.select("y", "y")).distinct(), "known")
    joined = components(label.select(F.col("x").alias("a"), F.col("y").alias("b"))).select(F.col("id").alias("component"), F.col("component").alias("whole"))
    return known.join(joined, "component", "left").select("id", F.coalesce("whole", "component").alias("component"))
