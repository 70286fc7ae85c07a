"""The operators as registered queries over the given tables, and their SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm import (
    covertree,
    jaccard,
    mixing,
    onebit,
    pieces,
    quality,
    repair,
    repeats,
    runs,
    secret_scan,
    templates,
    topk,
    warc,
)
from opsledger.llm.ship import ship


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(
        _table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.digests(documents, _table(spark, sf_dir, "labels", "doc_id", "quality"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return jaccard.near_duplicates(documents).drop("row", "group")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.digests(_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "source", "text")
    rows = documents.select(
        F.struct("doc_id").alias("row"),
        mixing.source_key(F.col("source")).alias("__source"),
        mixing.word_count(F.col("text")).alias("size"),
    )
    mixed = mixing.sample(rows, F.col("row.doc_id"), mixing.WEIGHTS, mixing.CAP, mixing.SEED)
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url", "html")
    archives = warc.write_archives(pages)
    records = warc.read_archives(archives, payloads=False).filter("kind = 'record'")
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return pieces.digests(documents)


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onebit.search(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digests(_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(_table(spark, sf_dir, "documents", "doc_id", "text"))


def registry():
    return {
        name: _shipped(query)
        for name, query in {
            "op1_secrets": op1_secrets,
            "op2_neardup": op2_neardup,
            "op3_quality": op3_quality,
            "op4_repeats": op4_repeats,
            "op5_jaccard": op5_jaccard,
            "op6_html": op6_html,
            "op7_mixing": op7_mixing,
            "op8_topk": op8_topk,
            "op9_warc": op9_warc,
            "op10_sentencepiece": op10_sentencepiece,
            "op11_neighbours": op11_neighbours,
            "op12_repair": op12_repair,
            "op13_runs": op13_runs,
        }.items()
    }


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def oracle_sql() -> dict[str, str]:
    return {
        "op2_neardup": _NEARDUP,
        "op4_repeats": _REPEATS,
        "op5_jaccard": _JACCARD,
        "op7_mixing": _MIXING,
        "op8_topk": _TOPK,
        "op9_warc": _WARC,
        "op11_neighbours": _NEIGHBOURS,
    }


_NEARDUP = """
WITH RECURSIVE fine AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
groups AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN groups g ON g.a = vec_id LEFT JOIN counts c ON c.a = vec_id
"""

_TOPK = """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM fine q JOIN fine c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# The index is approximate; what it returns for the given tables is the exact answer.
_NEIGHBOURS = """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(
    list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])),
    lambda a, b: a + b)) AS score
  FROM fine q JOIN fine c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank
  FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


_REPEATS = """
WITH worded AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM worded)),
late AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS k FROM windows)
  WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM late),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM worded),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words
  WHERE (doc_id, i) NOT IN (SELECT doc_id, i FROM gone) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM worded w LEFT JOIN kept k ON k.doc_id = w.doc_id LEFT JOIN counts c ON c.doc_id = w.doc_id
"""

_JACCARD = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS s FROM worded),
shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS c
  FROM shingles a JOIN shingles b ON a.t = b.t AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * c >= 75 * (n + m - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_id AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN least_id ON a = doc_id
"""

_MIXING = """
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source) - 1) % 3
    WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sums),
filled AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source) AS place FROM weighed),
levels AS (
  SELECT a.place, a.weight, a.source_size,
    ((SELECT sum(source_size) FROM filled)
      - 3 * coalesce((SELECT sum(b.source_size) FROM filled b WHERE b.place < a.place), 0))::DOUBLE
    / (SELECT sum(b.weight) FROM filled b WHERE b.place >= a.place)::DOUBLE AS level
  FROM filled a),
chosen AS (
  SELECT level FROM levels WHERE weight * level <= 3 * source_size ORDER BY place LIMIT 1),
targets AS (
  SELECT source, source_size,
    least(weight * (SELECT level FROM chosen), (3 * source_size)::DOUBLE) AS target FROM filled),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) - 1 AS place FROM sized),
rated AS (
  SELECT doc_id, size, source_size, target, place::HUGEINT AS place,
    CASE WHEN source_size > 0 THEN floor(target / source_size * 4294967296.0)::HUGEINT
      ELSE 0 END AS rate,
    ('0x' || substr(md5('mix' || source), 1, 8))::HUGEINT AS start
  FROM placed JOIN targets USING (source))
SELECT doc_id, size, source_size, target,
  (size * (((place + 1) * rate + start) // 4294967296 - (place * rate + start) // 4294967296))
    ::BIGINT AS taken
FROM rated
"""

_WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages),
marked AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
    THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS keeper FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM marked
"""
