"""Embedding near-dedup by a pivot-permutation index, and exact top-k search."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, written


def usable(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components that isn't null itself."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


SEEN = 0.6  # the least cosine of a link, seen from the mean of all vectors, that the pivot index finds well


# ---------------------------------------------------------------- exact top-k


def _tile_products(k: int, out: list[str]):
    """For one tile of queries and one of candidates: the k best of each query."""

    def best(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(shard):
            return pd.DataFrame({c: np.zeros(0, "int64") for c in out})
        shard = shard.sort_values("id", kind="stable")
        a, b = (np.stack(x["q"].to_numpy()).astype("int64") for x in (queries, shard))
        bound = float(np.abs(a.astype("float64")).max(initial=0)) * float(np.abs(b.astype("float64")).max(initial=0)) * max(1, a.shape[1])
        if bound < 2**53:  # every partial sum is an exact double
            score = (a.astype("float64") @ b.T.astype("float64")).astype("int64")
        else:  # exact integers, held within long
            exact = a.astype(object) @ b.T.astype(object)
            score = np.clip(exact, -(2**63), 2**63 - 1).astype("int64")
        ids, found = shard["id"].to_numpy(), []
        for query, row in zip(queries["id"].to_numpy(), score, strict=True):
            other = np.flatnonzero(ids != query)
            row = row[other]
            if len(row) > k:
                at = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
                row, other = row[at], other[at]
            first = np.lexsort((ids[other], -row.astype("float64") if bound < 2**53 else ~row))[:k]
            found.append((np.full(len(first), query), ids[other][first], row[first]))
        return pd.DataFrame(dict(zip(out, (np.concatenate(x) for x in zip(*found, strict=True)), strict=True)))

    return best


def top_k(queries: DataFrame, rows: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, query_tile: int = 1024, row_tile: int = 8192) -> DataFrame:
    """The k rows with the largest integer inner product for every query, exactly.

    Components become floor(scale * x). Queries and rows are dealt into tiles of a
    bounded number of rows; every pair of tiles is one matrix product with a partial
    selection, and the per-tile lists merge by a ranked window, which Spark limits
    before and after its shuffle. Only vectors of one length are compared; a row with
    the query's own id isn't its candidate; ties go to the smaller id. Vectors that are
    null or hold null or non-finite components, and rows without id, take no part.
    Values beyond long are held at its ends. Several queries of one id rank as one.
    Returns query_id, rank (int, from 1), vec_id, score.
    """

    def tiled(df: DataFrame, size: int) -> tuple[DataFrame, int]:
        df = df.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
            F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("q"), F.size(vector_col).alias("dim")
        )
        return df, max(1, math.ceil(df.count() / size))

    asked, n = tiled(queries, query_tile)
    held, m = tiled(rows, row_tile)
    mine = F.pmod(F.xxhash64("id"), F.lit(n)).alias("s"), F.pmod(F.xxhash64("id"), F.lit(m)).alias("t")
    every = lambda count, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias(name)
    asked, held = asked.select("*", mine[0], every(m, "t")), held.select("*", mine[1], every(n, "s"))
    key = ["dim", "s", "t"]
    lists = asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(_tile_products(k, ["query_id", "vec_id", "score"]), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


# ---------------------------------------------------------------- near-dedup


def _unit(vectors: pd.Series) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that large components don't overflow."""
    x = np.stack(vectors.to_numpy()).astype("float64")
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _seen(unit: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """The directions of unit vectors as seen from a centre; 0 for one that lies there."""
    x = unit - centre
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-300)


def _centres(candidates: Iterator[tuple[int, list]], cosine: float) -> dict[int, np.ndarray]:
    """From where the index looks at the vectors of each length: the mean of the candidates' unit
    vectors, since vectors in a cone look alike from 0. But 0 where the cosine of a link, seen
    from the mean, would be below SEEN: the index couldn't tell links from other pairs there."""
    total: dict[int, np.ndarray] = {}
    n: dict[int, int] = {}
    for dim, vector in candidates:
        total[dim] = total.get(dim, 0) + _unit(pd.Series([np.array(vector)]))[0]
        n[dim] = n.get(dim, 0) + 1
    means = {dim: x / n[dim] for dim, x in total.items()}
    return {dim: m if 1 - cosine <= (1 - SEEN) * (1 - m @ m) else np.zeros(dim) for dim, m in means.items()}


def _described(pivots: dict[int, np.ndarray], centres: dict[int, np.ndarray], nearest: int, words: int):
    """Adds to each vector its nearest pivots in order, and the same as a bit set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                p = pivots[int(dim)]
                order = np.argsort(-(_seen(_unit(part["v"]), centres[int(dim)]) @ p.T), axis=1, kind="stable")[:, :nearest].astype("int32")
                bits = np.zeros((len(part), words), "int64").view("uint64")
                for col in order.T:
                    bits[np.arange(len(part)), col // 64] |= np.uint64(1) << (col % 64).astype("uint64")
                yield part.assign(pivots=list(order), bits=list(bits.view("int64")))

    return run


def _apart(candidates: Iterator[tuple[int, list]], centres: dict[int, np.ndarray], count: int, cosine: float) -> dict[int, np.ndarray]:
    """The pivots of each length: of the candidates (length, vector), in their order, at most
    `count` whose cosine with every pivot before them, seen from the centre, is below `cosine`.
    Only pivots are held."""
    chosen: dict[int, np.ndarray] = {}
    held: dict[int, int] = {}
    for dim, vector in candidates:
        n, p = held.get(dim, 0), chosen.get(dim)
        if n == count:
            continue
        x = _seen(_unit(pd.Series([np.array(vector)])), centres[dim])[0]
        if n and (p[:n] @ x).max() >= cosine:
            continue
        if p is None or n == len(p):
            chosen[dim] = p = np.concatenate([p, np.empty_like(p)]) if n else np.empty((1, dim))
        p[n], held[dim] = x, n + 1
    return {dim: p[: held[dim]] for dim, p in chosen.items()}


def _links_of_tile(cosine: float, need: dict[int, int]):
    """Verified links within one tile of a pivot's list: for each linked vector the
    smallest vector that it reaches within the tile, and how many vectors it is linked with."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        dim, p, i, j = key
        rows = rows.sort_values("id", kind="stable")
        ids, copies, block, home = (rows[c].to_numpy() for c in ("id", "copies", "block", "home"))
        bits, unit = np.stack(rows["bits"].to_numpy()).view("uint64"), _unit(rows["v"])
        left = np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        cos = unit[left] @ unit[right].T
        a, b = np.nonzero(cos >= cosine - 1e-12)
        cos, a, b = cos[a, b], left[a], right[b]
        if i == j:
            cos, a, b = cos[a < b], a[a < b], b[a < b]
        below = np.array([(1 << min(64, max(0, int(p) - 64 * w))) - 1 for w in range(bits.shape[1])], "uint64")
        linked = np.zeros(len(a), bool)
        for s in range(0, len(a), 65536):
            x, y = a[s : s + 65536], b[s : s + 65536]
            common = bits[x] & bits[y]
            enough = (np.bitwise_count(common).sum(axis=1, dtype="int64") >= need[int(dim)]) | (home[x] == home[y])
            linked[s : s + 65536] = enough & ~(common & below).any(axis=1)  # a pivot before this one is shared too: that list has the pair
        for at in np.flatnonzero(linked & (np.abs(cos - cosine) < 1e-12)):  # decided by correctly rounded sums
            x, y = (rows["v"].iloc[t].astype("float64") for t in (a[at], b[at]))
            linked[at] = math.fsum(x * y) >= cosine * math.sqrt(math.fsum(x * x)) * math.sqrt(math.fsum(y * y))
        a, b = a[linked], b[linked]
        links, root = np.zeros(len(ids), "int64"), np.arange(len(ids))
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            for x in (a, b):
                np.minimum.at(new, x, low)
                np.minimum.at(new, root[x], low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        at = np.flatnonzero(links)
        return pd.DataFrame({"id": ids[at], "root": ids[root[at]], "links": links[at]})

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, pivots: int | None = None, nearest: int = 12, shared: int = 3, tile: int = 1500) -> DataFrame:
    """Links of vectors with a cosine of at least `cosine`, found through a pivot index.

    Equal vectors form one class, which the index holds once. Pivots are taken by hash (256
    to 4096, growing with the table, or `pivots`; four times as many candidates: a bounded
    sample), but none within twice the angle of `cosine` of another. So a dense group around
    one vector has few pivots however many of the rows it holds. Angles of the index are seen
    from the mean of these candidates (see _centres()), so vectors in a cone, which are all
    near each other, have many pivots too. Every class is described by its `nearest` pivots in order
    and stands in their inverted lists; all pairs of a list are compared in double precision
    and linked if they have the same nearest pivot or share `shared` pivots at least (all,
    where a length has fewer). In a cone so narrow that links hardly differ from other pairs
    all vectors share one list. A list is split into blocks of about `tile` classes and handled
    by pairs of blocks, so no list has to fit in one task. A tile returns a spanning forest and link
    counts, never all pairs; equal vectors are counted, not paired.

    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing, nor do vectors of different lengths. Rows that share an id are counted each.
    Returns a row per input row: id_col, n_links (other vectors linked directly),
    component_id (smallest id reachable, itself included), kept (whether that is itself).
    """
    v = F.col(vector_col)
    good = usable(v) & F.exists(v, lambda x: x != 0) & F.col(id_col).isNotNull()
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(good, F.transform(v, lambda x: x + F.lit(0).cast("float"))).alias("v"))
    classes = rows.where("v is not null").groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies")).withColumn("dim", F.size("v"))
    classes = written(classes, "classes")
    count = pivots or min(4096, max(256, classes.count() // 256))
    first = Window.partitionBy("dim").orderBy(F.xxhash64("id", F.lit(7)), "id")
    candidates = classes.withColumn("r", F.row_number().over(first)).where(F.col("r") <= 4 * count).select("dim", "r", "v")
    candidates = written(candidates, "candidates").orderBy("dim", "r")
    drawn = lambda: ((r["dim"], r["v"]) for r in candidates.toLocalIterator())
    centres = _centres(drawn(), cosine)
    table = _apart(drawn(), centres, count, max(-1.0, 2 * cosine * abs(cosine) - 1))
    words = math.ceil(count / 64)
    kind = classes.schema["v"].dataType.simpleString()
    schema = f"v {kind}, id long, copies long, dim int, pivots array<int>, bits array<long>"
    described = written(classes.mapInPandas(_described(table, centres, nearest, words), schema), "described")
    posts = described.select("*", F.col("pivots")[0].alias("home"), F.explode("pivots").alias("pivot")).drop("pivots")
    sizes = described.select("dim", F.explode("pivots").alias("pivot")).groupBy("dim", "pivot").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks"))
    posts = posts.join(sizes, ["dim", "pivot"]).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    posts = posts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    tiles = posts.select("dim", "pivot", "i", "j", "block", "id", "copies", "bits", "home", "v")
    need = {dim: min(shared, nearest, len(p)) for dim, p in table.items()}
    found = written(tiles.groupBy("dim", "pivot", "i", "j").applyInPandas(_links_of_tile(cosine, need), "id long, root long, links long"), "links")
    groups = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    result = classes.join(links, "id", "left").join(groups, "id", "left")
    result = result.select("v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.join(result, "v", "left").select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
