"""Quality classifier: an interpolated modified Kneser-Ney model of character trigrams,
trained on trusted text of each language; documents are judged by perplexity."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _saved, written

SIZE = 128  # symbols of a language's table in the workers: start, unseen, and its 126 most frequent characters
START, UNSEEN, RARE = 0, 1, 255  # RARE: seen in training, but not in the table
LISTED = 10_000  # so many names of languages the workers know
NUMBERS = "lang string, a int, b int, c int, logp float"
_tables: dict = {}
POOLED = ""  # the model of all trusted text, for languages without one of their own
CHUNK_CHARS = 1 << 20
_PAD = "\x02\x02"
_FOLD = np.arange(0x110000, dtype="uint32")
_FOLD[48:58] = 48  # digits are one character, and so is white space
_FOLD[[9, 10, 11, 12, 13, 160]] = 32


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of all texts, each after two start marks; where each text begins."""
    codes = _FOLD[np.frombuffer("".join(_PAD + t for t in texts).encode("utf-32-le", "surrogatepass"), "uint32")]
    return codes, np.cumsum([0] + [len(t) + len(_PAD) for t in texts])


def _ends(begins: np.ndarray) -> np.ndarray:
    """Where trigrams that end at a text's own characters begin."""
    keep = np.ones(begins[-1], bool)
    for k in range(len(_PAD)):
        keep[np.minimum(begins[:-1] + k, begins[-1] - 1)] = False
    return np.flatnonzero(keep) - len(_PAD)


def _by_language(batch: pa.RecordBatch, lang: str = "lang", text: str = "text") -> Iterator[tuple[int, int, dict[str, list[int]], list[str]]]:
    """Slices lo .. hi of a batch with a bounded number of characters: the places (from lo on) of
    each language, and the texts."""
    names = batch.schema.names
    langs, texts = batch.column(names.index(lang)), batch.column(names.index(text))
    sizes = [x or 0 for x in pc.utf8_length(texts).to_pylist()]
    lo = total = 0
    for hi in range(len(sizes) + 1):
        if hi > lo and (hi == len(sizes) or total + sizes[hi] > CHUNK_CHARS):
            places: dict[str, list[int]] = {}
            for i, x in enumerate(langs.slice(lo, hi - lo).to_pylist()):
                places.setdefault(x or POOLED, []).append(i)
            yield lo, hi, places, [t or "" for t in texts.slice(lo, hi - lo).to_pylist()]
            lo, total = hi, 0
        total += sizes[hi] if hi < len(sizes) else 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of trigrams of code points (21 bits each), for each language and slice."""
    for batch in batches:
        for _, _, places, texts in _by_language(batch):
            for lang, at in places.items():
                codes, begins = _codes([texts[i] for i in at])
                c = codes.astype("int64")
                e = _ends(begins)
                key, n = np.unique((c[e] << 42) | (c[e + 1] << 21) | c[e + 2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key), pa.array(n.astype("int64"))], ["lang", "key", "n"])


@dataclass
class Model:
    """The whole model is the table at `path`, with the rows of kneser_ney() of all languages and
    characters. The rest is what workers know of it. Per language with a table: the code points that
    have symbols 2, 3, ..., the other ones that were seen, and the rows of kneser_ney() with symbols
    alone. listed: all languages that have a model, or None if there are too many. name tells models apart."""

    codes: dict[str, np.ndarray]
    rare: dict[str, np.ndarray]
    rows: dict[str, pd.DataFrame]
    listed: set[str] | None
    path: str
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def language(self, lang: str | None) -> str | None:
        """The language whose table scores lang; None if there may be a model of it, but no table."""
        if lang in self.rows:
            return lang
        return POOLED if self.listed is not None and lang not in self.listed else None

    def table(self, lang: str) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of every code point, and log p of every trigram of symbols. A
        process keeps the tables of one model: it lays a language out when it first needs it."""
        if _tables.get("model") != self.name:
            _tables.clear()
            _tables["model"] = self.name
        if lang not in _tables:
            symbols = np.full(len(_FOLD), UNSEEN, "uint8")
            symbols[self.rare[lang]] = RARE
            symbols[self.codes[lang]] = np.arange(len(self.codes[lang])) + 2
            symbols[ord(_PAD[0])] = START
            _tables[lang] = symbols, _dense(self.rows[lang], SIZE)
        return _tables[lang]


def kneser_ney(counts: DataFrame) -> DataFrame:
    """log p of interpolated modified Kneser-Ney from counts (lang, a, b, c, n) of symbols.

    Trigrams have their own counts, shorter ones count the different symbols before them;
    every order has discounts for counts 1, 2 and more from the numbers of n-grams seen one
    to four times (Chen and Goodman), and gives what they free to the next shorter order, the
    last to a uniform distribution. All of it are sums and equi-joins of count tables that
    are sharded by their n-gram. Returns (lang, a, b, c, logp): a = b = c = null stands for
    an unknown symbol, and every order has the rows seen there: (a, b, c); (null, b, c),
    (null, null, c); and, with c null, the log of what a context frees: (a, b, null),
    (null, b, null)."""
    three = written(counts.groupBy("lang", "a", "b", "c").agg(F.sum("n").alias("k")), "three")
    two = written(three.groupBy("lang", "b", "c").agg(F.count("*").alias("k")), "two")
    one = written(two.groupBy("lang", "c").agg(F.count("*").alias("k")), "one")

    def order(t: DataFrame, context: list[str]) -> tuple[DataFrame, DataFrame]:
        m = t.groupBy("lang").agg(*[F.sum((F.col("k") == i).cast("double")).alias(f"m{i}") for i in (1, 2, 3, 4)])
        y = F.col("m1") / F.greatest(F.lit(1.0), F.col("m1") + 2 * F.col("m2"))
        cut = [F.greatest(F.lit(0.1), F.least(F.lit(i - 0.01), i - (i + 1) * y * F.col(f"m{i + 1}") / F.greatest(F.lit(1.0), F.col(f"m{i}")))).alias(f"d{i}") for i in (1, 2, 3)]
        t = t.join(m.select("lang", *cut), "lang").withColumn("d", F.when(F.col("k") == 1, F.col("d1")).when(F.col("k") == 2, F.col("d2")).otherwise(F.col("d3")))
        t = written(t.drop("d1", "d2", "d3"), "discounted")
        freed = written(t.groupBy("lang", *context).agg(F.sum("k").alias("total"), (F.sum(F.least("d", "k")) / F.sum("k")).alias("freed")), "freed")
        t = t.join(freed, ["lang", *context])
        return t.select("lang", *[c for c in ("a", "b", "c") if c in t.columns], (F.greatest(F.lit(0.0), F.col("k") - F.col("d")) / F.col("total")).alias("p"), "freed"), freed

    p1, free1 = order(one, [])
    base = one.groupBy("lang").agg((1.0 / (F.count("*") + 1)).alias("u"))
    p1 = written(p1.join(base, "lang").select("lang", "c", (F.col("p") + F.col("freed") * F.col("u")).alias("q")), "p1")
    p2, free2 = order(two, ["b"])
    p2 = written(p2.join(p1, ["lang", "c"]).select("lang", "b", "c", (F.col("p") + F.col("freed") * F.col("q")).alias("q")), "p2")
    p3, free3 = order(three, ["a", "b"])
    p3 = p3.join(p2, ["lang", "b", "c"]).select("lang", "a", "b", "c", (F.col("p") + F.col("freed") * F.col("q")).alias("q"))
    no = lambda x: F.lit(None).cast("int").alias(x)
    parts = [
        p3, p2.select("lang", no("a"), "b", "c", "q"), p1.select("lang", no("a"), no("b"), "c", "q"),
        free3.select("lang", "a", "b", no("c"), F.col("freed").alias("q")), free2.select("lang", no("a"), "b", no("c"), F.col("freed").alias("q")),
        free1.join(base, "lang").select("lang", no("a"), no("b"), no("c"), (F.col("freed") * F.col("u")).alias("q")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.select("lang", "a", "b", "c", F.ln("q").cast("float").alias("logp"))


def train(trusted: DataFrame, max_languages: int = 15, size: int = SIZE) -> Model:
    """The model of `trusted` (lang, text), from all of it: every language gets a model of all its
    characters, and all text together gives the pooled one. The driver collects a part of it for the
    workers: trigrams of the `size` most frequent characters of the `max_languages` languages with most
    text and of the pooled model, so (max_languages + 1) * SIZE**3 rows at most, however large the
    corpus is, and which code points they saw. Other trigrams are joined with the whole table (rare_sums())."""
    raw = written(trusted.select("lang", "text").mapInArrow(_count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")), "trigrams")
    raw = raw.where(F.col("lang") != POOLED).union(raw.select(F.lit(POOLED), "key", "n"))
    own = raw.groupBy("lang").agg(F.sum("n").alias("n")).where(F.col("lang") != POOLED).orderBy(F.desc("n"), "lang").limit(max_languages).select("lang")
    own = [r.lang for r in own.collect()] + [POOLED]
    seen = written(raw.groupBy("lang", F.col("key").bitwiseAND((1 << 21) - 1).cast("int").alias("code")).agg(F.sum("n").alias("n")), "seen")
    listed = [r.lang for r in seen.select("lang").distinct().limit(LISTED + 1).collect()]
    most = seen.where(F.col("lang").isin(own) & (F.col("code") != ord(_PAD[0])))
    most = written(most.withColumn("s", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code")) + 1).select("lang", "code", "s"), "symbols")
    codes: dict[str, list[int]] = {lang: [] for lang in own}
    rare: dict[str, list[int]] = {lang: [] for lang in own}
    for r in most.orderBy("lang", "s").collect():  # a language has no more than there are code points
        (codes if r.s < size else rare)[r.lang].append(r.code)
    counts = raw
    for name, shift in (("a", 42), ("b", 21), ("c", 0)):
        counts = counts.withColumn(name, F.shiftright("key", shift).bitwiseAND((1 << 21) - 1).cast("int"))
    table, path = _saved(kneser_ney(counts.select("lang", "a", "b", "c", "n")), "model")
    most, found = F.broadcast(most.where(F.col("s") < size)), table.where(F.col("lang").isin(own))  # SIZE rows a language
    for name in ("a", "b", "c"):
        found = found.withColumn("code", F.col(name)).join(most, ["lang", "code"], "left").withColumn("s", F.when(F.col("code") == ord(_PAD[0]), START).otherwise(F.col("s")))
        found = found.where("code IS NULL OR s IS NOT NULL").withColumn(name, F.col("s")).drop("s", "code")
    found = found.toPandas()
    arrays = lambda x: {k: np.array(v, "int64") for k, v in x.items()}
    rows = {lang: found.loc[found["lang"] == lang, ["a", "b", "c", "logp"]].astype("float32") for lang in own}
    return Model(arrays(codes), arrays(rare), rows, set(listed) if len(listed) <= LISTED else None, path)


def _dense(rows: pd.DataFrame, size: int) -> np.ndarray:
    """log p for every trigram: the longest order that was seen, times what the contexts above it freed."""
    seen = rows.notna()
    pick = lambda a, b, c: rows[(seen["a"] == a) & (seen["b"] == b) & (seen["c"] == c)]
    unknown = pick(False, False, False)["logp"]
    p1 = np.full(size, unknown.iloc[0] if len(unknown) else -np.log(size), "float32")
    r = pick(False, False, True)
    p1[r["c"].astype(int)] = r["logp"]
    free = np.zeros(size, "float32")
    r = pick(False, True, False)
    free[r["b"].astype(int)] = r["logp"]
    p2 = free[:, None] + p1[None, :]
    r = pick(False, True, True)
    p2[r["b"].astype(int), r["c"].astype(int)] = r["logp"]
    free = np.zeros((size, size), "float32")
    r = pick(True, True, False)
    free[r["a"].astype(int), r["b"].astype(int)] = r["logp"]
    p3 = free[:, :, None] + p2[None, :, :]
    r = pick(True, True, True)
    p3[r["a"].astype(int), r["b"].astype(int), r["c"].astype(int)] = r["logp"]
    return p3.ravel()


def _read(m: Model, batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[tuple[str, list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]]]:
    """Slices lo .. hi of a batch; of each language there: its name, its texts' places (from lo on), their
    sizes, their code points, where trigrams begin, and log p of them. That is NaN for those that the
    workers' part of the model doesn't tell."""
    for lo, hi, places, texts in _by_language(batch):
        out = []
        for lang, at in places.items():
            codes, begins = _codes([texts[i] for i in at])
            e, own = _ends(begins), m.language(lang)
            if own is None:
                lp = np.full(len(e), np.nan)
            else:
                symbols, logp = m.table(own)
                s = symbols[codes].astype("int32")
                rare = (s[e] == RARE) | (s[e + 1] == RARE) | (s[e + 2] == RARE)
                s[s == RARE] = UNSEEN
                lp = logp[(s[e] * SIZE + s[e + 1]) * SIZE + s[e + 2]].astype("float64")
                lp[rare] = np.nan
            out.append((lang if own is None else own, at, np.diff(begins) - len(_PAD), codes, e, lp))
        yield lo, hi, out


def _key() -> Column:
    """A hash of language and text: rows that have both in common have one score."""
    return F.xxhash64("lang", "text")


def rare_sums(docs: DataFrame, model: Broadcast) -> DataFrame | None:
    """Sums of log p and of its square over the trigrams of each text (key, s, q) that the workers'
    part of the model doesn't tell, from joins with the whole model; None if there are none. A text
    gives each of these trigrams once, and a different one is looked up once."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.names.index("key")).to_numpy()
            for lo, _, parts in _read(model.value, batch):
                for lang, at, size, codes, e, lp in parts:
                    rare = np.flatnonzero(np.isnan(lp))
                    if len(rare):
                        c = codes.astype("int64")
                        gram, which = np.unique((c[e[rare]] << 42) | (c[e[rare] + 1] << 21) | c[e[rare] + 2], return_inverse=True)
                        pair, k = np.unique(np.repeat(np.arange(len(at)), size)[rare] * len(gram) + which, return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(keys[lo + np.array(at)[pair // len(gram)]]), pa.array([lang] * len(pair), pa.string()), pa.array(gram[pair % len(gram)]), pa.array(k.astype("int64"))], ["key", "lang", "gram", "k"])

    rare = written(docs.select("lang", "text", _key().alias("key")).mapInArrow(run, "key long, lang string, gram long, k long").distinct(), "rare")
    if rare.isEmpty():
        return None
    whole = spark.read.schema(NUMBERS).parquet(model.value.path)
    unknown = whole.where("a IS NULL AND b IS NULL AND c IS NULL").select("lang", F.col("logp").alias("u"))
    grams = rare.select("lang", "gram").distinct().join(unknown.select("lang", F.lit(True).alias("own")), "lang", "left").select(F.col("lang").alias("for"), F.when(F.col("own"), F.col("lang")).otherwise(POOLED).alias("lang"), "gram")
    for name, shift in (("a", 42), ("b", 21), ("c", 0)):
        grams = grams.withColumn(name, F.shiftright("gram", shift).bitwiseAND((1 << 21) - 1).cast("int"))
    for name, on in (("p3", "abc"), ("f3", "ab"), ("p2", "bc"), ("f2", "b"), ("p1", "c")):
        rows = whole.where(" AND ".join(f"{x} IS {'NOT ' * (x in on)}NULL" for x in "abc"))
        grams = grams.join(rows.select("lang", *on, F.col("logp").cast("double").alias(name)), ["lang", *on], "left")
    grams = grams.join(unknown, "lang", "left")
    zero = F.lit(0.0)
    one = F.coalesce("p1", F.col("u").cast("double"), F.lit(-math.log(SIZE)))
    lp = F.coalesce("p3", F.coalesce("f3", zero) + F.coalesce("p2", F.coalesce("f2", zero) + one))
    grams = grams.select(F.col("for").alias("lang"), "gram", lp.alias("lp"))
    return written(rare.join(grams, ["lang", "gram"]).groupBy("key").agg(F.sum(F.col("k") * F.col("lp")).alias("s"), F.sum(F.col("k") * F.col("lp") * F.col("lp")).alias("q")), "sums")


def scored(docs: DataFrame, model: Broadcast, into: str = "score", rare: DataFrame | None | str = "") -> DataFrame:
    """docs (with lang and text) and a struct `into` (an existing one is replaced): n
    (characters), nats (mean of -log p) and error (its standard error) of the text under its
    language's model. n = 0 for null or empty. A task works on CHUNK_CHARS characters at a time.
    rare: what rare_sums() gives, if it is known."""
    rare = rare_sums(docs, model) if isinstance(rare, str) else rare
    names = [c for c in docs.columns if c != into]
    key = f"__{into}_key"
    raw = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.DoubleType()), T.StructField("q", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, parts in _read(model.value, batch):
                n, s, q = np.zeros(hi - lo, "int64"), np.zeros(hi - lo), np.zeros(hi - lo)
                for _, at, size, _, _, lp in parts:
                    lp = np.nan_to_num(lp, copy=False)
                    cut = np.concatenate([[0], np.cumsum(size)])
                    n[at] = size
                    s[at], q[at] = (np.diff(np.concatenate([[0.0], np.cumsum(x)])[cut]) for x in (lp, lp * lp))
                part = batch.slice(lo, hi - lo)
                found = pa.StructArray.from_arrays([pa.array(n), pa.array(s), pa.array(q)], raw.names)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(part.num_columns)), found], [*part.schema.names, into])

    keyed = docs.select(*[F.col(f"`{c}`") for c in names], *([] if rare is None else [_key().alias(key)]))
    out = keyed.mapInArrow(run, T.StructType([*keyed.schema.fields, T.StructField(into, raw)]))
    s, q, n = F.col(f"`{into}`.s"), F.col(f"`{into}`.q"), F.greatest(F.lit(1), F.col(f"`{into}`.n"))
    if rare is not None:
        out = out.join(rare.select(F.col("key").alias(key), F.struct("s", "q").alias(f"{key}_rare")), key, "left")
        s, q = s + F.coalesce(F.col(f"`{key}_rare`.s"), F.lit(0.0)), q + F.coalesce(F.col(f"`{key}_rare`.q"), F.lit(0.0))
    error = F.sqrt(F.greatest(F.lit(0.0), q / n - (s / n) * (s / n)) / n)
    return out.select(*[F.col(f"`{c}`") for c in names], F.struct(F.col(f"`{into}`.n").alias("n"), (-s / n).alias("nats"), error.alias("error")).alias(into))


def _judge(docs: DataFrame, trusted: DataFrame, quantile: float, slack: float, **options) -> tuple[Broadcast, DataFrame | None, DataFrame, DataFrame, float]:
    """The model, rare_sums(), (doc_id, lang, score) of all documents, the limits of languages (__of, __limit), and that of others."""
    trusted = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct()
    # many ids can't be broadcast: texts go to them unsorted, a task holds its own ids only
    model = train(docs.select("doc_id", "lang", "text").join(trusted.hint("shuffle_hash"), "doc_id", "left_semi"), **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: see train()
    rare = rare_sums(docs, shared)
    scores = written(scored(docs.select("doc_id", "lang", "text"), shared, rare=rare).select("doc_id", "lang", "score"), "scores")
    nats = scores.where("score.n > 0").join(trusted, "doc_id", "left_semi").select(F.coalesce("lang", F.lit(POOLED)).alias("lang"), "score.nats")  # of trusted text, so there is a model
    every = nats.where(F.col("lang") != POOLED).union(nats.select(F.lit(POOLED), "nats"))
    limits = written(every.groupBy(F.col("lang").alias("__of")).agg((F.percentile_approx("nats", quantile, 10_000) + slack).alias("__limit")), "limits")
    pooled = limits.where(F.col("__of") == POOLED).first()
    return shared, rare, scores, limits, pooled["__limit"] if pooled else float("inf")


def _limited(scored: DataFrame, limits: DataFrame, pooled: float) -> tuple[DataFrame, Column]:
    """The scored rows, and the limit of a row's language."""
    return scored.join(limits, F.col("lang") == F.col("__of"), "left"), F.coalesce("__limit", F.lit(pooled))


def _verdict(score: str, limit: Column, errors: float) -> list[Column]:
    q = lambda x: F.col(f"{score}.{x}")
    keep = (q("n") == 0) | (q("nats") - errors * q("error") <= limit)
    return [q("n").alias("n"), F.when(q("n") > 0, F.exp(q("nats"))).alias("perplexity"), F.exp(limit).alias("limit"), keep.alias("keep")]


def classify(docs: DataFrame, trusted: DataFrame, quantile: float = 0.95, slack: float = 0.08, errors: float = 1.0, into: str = "quality", **options) -> DataFrame:
    """docs with a column `into` (an existing one is replaced): a struct of n, perplexity (per
    character), limit and keep. `trusted` has the doc_id of documents of good quality.

    The model is trained on all trusted documents, with all their languages and characters, and everything else covers all rows too.
    A language's limit is the `quantile` of the nats per character of
    all its trusted texts, plus `slack`. A document is rejected when its nats are above the
    limit by more than `errors` standard errors: a short text needs stronger evidence. Null
    and empty texts have no perplexity and are kept. With no trusted text, all is kept.
    """
    shared, rare, _, limits, pooled = _judge(docs, trusted, quantile, slack, **options)
    rows, limit = _limited(scored(docs, shared, into, rare), limits, pooled)
    return rows.withColumn(into, F.struct(*_verdict(into, limit, errors))).drop("__of", "__limit")


def report(docs: DataFrame, trusted: DataFrame, quantile: float = 0.95, slack: float = 0.08, errors: float = 1.0, **options) -> DataFrame:
    """A row per document: doc_id, lang, and what classify() says of it."""
    _, _, scores, limits, pooled = _judge(docs, trusted, quantile, slack, **options)
    rows, limit = _limited(scores, limits, pooled)
    return rows.select("doc_id", "lang", *_verdict("score", limit, errors))


def trusted_rows(labels: DataFrame) -> DataFrame:
    """doc_id of documents that are labelled as of good quality, by every label they have."""
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")


def kept(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier keeps, with their columns."""
    return classify(docs, trusted_rows(labels), into="__quality", **options).where("__quality.keep").select(*docs.columns)
