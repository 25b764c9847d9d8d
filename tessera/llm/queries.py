"""The thin queries over the operators of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, html, jaccard, lines, mixing, passages, pieces, quality, secrets, sharding, spelling, vectors

#: The vocabulary that op2 and the pipeline use; any SentencePiece model file will do.
PIECES = os.environ.get("TESSERA_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether decoding them gives the text again."""
    docs = pieces.encoded(_table(spark, sf_dir, "documents").select("doc_id", "text"), PIECES, same="same")
    return docs.select("doc_id", pieces.count("ids").alias("n_ids"), "same", "ids")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.length("html").alias("html_chars"), "text")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"), quality.trusted_rows(_table(spark, sf_dir, "labels")))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(_table(spark, sf_dir, "documents"), report=True)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(_table(spark, sf_dir, "documents"), n=4, percent=85)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return vectors.top_k(rows.where(F.col("vec_id") % 50 == 0), rows)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_report(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_report(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_sentencepiece, op3_html_extraction, op4_quality_classifier, op5_embedding_near_dedup, op6_line_dedup, op7_jaccard_join, op8_secret_scan, op9_exact_top_k, op10_substring_dedup, op11_collocations, op12_sharding, op13_spelling_variants)}

ORACLES = {
    "op7_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 4 THEN [array_to_string(t, ' ')]
    ELSE list_distinct(list_transform(range(1, len(t) - 2), lambda i: array_to_string(t[i:i + 3], ' '))) END AS g FROM w
), u AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, least.component_id FROM s JOIN least USING (doc_id)""",
    "op9_exact_top_k": """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM good a JOIN good b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op11_collocations": r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), f AS (
  SELECT lang, phrase, k, count(*) AS n FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM piece, range(1, 4) t(k) WHERE len(w) >= k) GROUP BY ALL
), cand AS (SELECT lang, phrase, k, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10
), longer AS (
  SELECT lang, phrase, max(a) AS above FROM (SELECT lang, a, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:], ' ')]) AS phrase FROM cand WHERE k > 2) GROUP BY ALL
), cut AS (
  SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS first, array_to_string(w[c + 1:], ' ') AS rest
  FROM cand LEFT JOIN longer USING (lang, phrase), range(1, 3) t(c) WHERE c < k AND (above IS NULL OR 100 * above < 50 * a)
), scored AS (
  SELECT cut.lang, cut.phrase, a, c, x.n AS l, y.n AS r, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = first JOIN f y ON y.lang = cut.lang AND y.phrase = rest
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
), total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1)
SELECT lang, rank, phrase, a, l, r, total.n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
    "op12_sharding": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: CAST('0x' || b AS BIGINT)) AS bytes,
    '{"doc_id":' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ',"text":' || coalesce('"' || md5(text) || '"', 'null') || ',"lang":' || coalesce('"' || md5(lang) || '"', 'null') || ',"source":' || coalesce('"' || md5(source) || '"', 'null')
      || ',"n_chars":' || coalesce(CAST(n_chars AS VARCHAR), 'null') || '}' AS id FROM documents
), tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), nth AS (SELECT *, row_number() OVER (PARTITION BY id) - 1 AS nth FROM docs
), total AS (SELECT count(*) AS n, greatest(1, CAST(ceil(count(*) / 1024) AS BIGINT)) AS buckets FROM docs
), dealt AS (SELECT nth.*, CAST('0x' || substr(md5('scatter:0:' || id || ':' || nth), 1, 15) AS BIGINT) % buckets AS bucket FROM nth, total
), held AS (SELECT bucket, count(*) AS n, list(doc_id ORDER BY id, nth) AS doc_id, list(size ORDER BY id, nth) AS size, list(crc ORDER BY id, nth) AS crc FROM (
    SELECT dealt.*, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS crc FROM dealt, tab) GROUP BY bucket
), draws AS (SELECT *, coalesce(sum(n) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    list_transform(range(n), lambda i: [CAST('0x' || substr(md5('order:0:' || bucket || ':' || i), 1, 15) AS BIGINT) % (i + 1)]) AS draw FROM held
), turned AS (SELECT *, list_reduce(list_prepend(CAST([] AS BIGINT[]), draw), lambda a, j: CASE WHEN j[1] = len(a) THEN list_append(a, len(a)) ELSE a[1:j[1]] || [len(a)] || a[j[1] + 2:] || [a[j[1] + 1]] END) AS turn FROM draws
), placed AS (SELECT doc_id[turn[i] + 1] AS doc_id, size[turn[i] + 1] AS size, crc[turn[i] + 1] AS crc, CAST(before + i - 1 AS BIGINT) AS place FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM turned)
), sharded AS (SELECT placed.*, CAST(place * 24 // n AS INTEGER) AS shard, n FROM placed, total)
SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'rows' AS law, shard, place - (CAST(shard AS BIGINT) * n + 23) // 24 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM sharded""",
    "op13_spelling_variants": r"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), run AS (
  SELECT d, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS w FROM documents) WHERE length(w) > 6 GROUP BY ALL
), bytes AS (SELECT w, n, list_transform(regexp_extract_all(hex(encode(d || ':' || w)), '..'), lambda b: CAST('0x' || b AS BIGINT)) AS bytes FROM run
), hashed AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS h FROM bytes, tab
), typed AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed
), words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2
), without AS (SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.rest = b.word
), best AS (SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS form, max(n) AS form_n FROM pairs GROUP BY 1
), facts AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM words LEFT JOIN best USING (word)
), chain AS (SELECT word, word AS last FROM facts UNION ALL SELECT chain.word, facts.form FROM chain JOIN facts ON facts.word = chain.last WHERE facts.form IS NOT NULL
), root AS (SELECT chain.word, last AS root FROM chain JOIN facts ON facts.word = chain.last WHERE facts.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM facts JOIN root USING (word)""",
}
