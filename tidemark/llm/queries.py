"""The registered queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import build_index, contamination
from tidemark.llm import conversations, fixity, quality, topk, toxicity
from tidemark.llm.clustering import clusters
from tidemark.llm.licences import licence_digest
from tidemark.llm.mixing import measure, mix
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.sharding import shard_digest
from tidemark.llm.substrings import remove_repeats
from tidemark.llm.tokens import token_digest, write_tokens
from tidemark.session import work_path

REGISTRY = {}
ORACLES: dict[str, str] = {}


def query(f):
    REGISTRY[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary())
    return token_digest(spark, path)


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "positional-index")
    build_index(table(spark, sf_dir, "documents"), path)
    return contamination(spark, path, table(spark, sf_dir, "benchmark"))


@query
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_digest(table(spark, sf_dir, "documents"))


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "sizes")
    measure(table(spark, sf_dir, "documents")).write.parquet(path)
    return mix(spark.read.parquet(path)).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits a replica of the archive of all pages in which records were harmed by rule, and reports every record.

    In the replica, records of pages with page_id % 1000 = 17 have their first byte changed, and those with 29 are lost.
    """
    path = work_path(spark, "warc")
    fixity.write_archive(table(spark, sf_dir, "pages"), f"{path}/records")
    archive = fixity.read_archive(spark, f"{path}/records")
    rest = F.coalesce(F.col("page_id") % 1000, F.lit(0))
    harmed = F.when(rest == 17, F.overlay("record", F.lit("w").cast("binary"), 1)).otherwise(F.col("record"))
    archive.filter(rest != 29).withColumn("record", harmed).write.option("compression", "zstd").parquet(f"{path}/replica")
    trees = []
    for name, rows in (("own", archive), ("other", spark.read.parquet(f"{path}/replica"))):
        at = f"{path}/{name}"
        fixity.write_fixity(rows, f"{at}/fixity")
        trees.append((f"{at}/fixity", f"{at}/tree", fixity.write_tree(spark, f"{at}/fixity", f"{at}/tree")))
    found = fixity.audit(spark, *trees)
    records = fixity.with_offsets(spark.read.parquet(trees[0][0]))
    leaves = spark.read.parquet(f"{trees[0][1]}/level=0").select(
        F.col("node").alias("range_no"), F.col("sha256").alias("range_sha256")
    )
    range_no = F.floor(F.col("position") / fixity.FAN_OUT)
    return (
        records.join(found, "position", "left")
        .withColumn("range_no", range_no)
        .join(leaves, "range_no", "left")
        .select(
            "position", "page_id", "offset", "length", "sha256", "range_no", "range_sha256",
            F.coalesce("status", F.lit("intact")).alias("status"),
        )
    )


ORACLES["op8_warc_fixity"] = """
WITH text AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || coalesce(page_id, 0) || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages),
hashed AS (SELECT page_id, CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS sha256 FROM text),
placed AS (
  SELECT *, row_number() OVER w - 1 AS position,
    CAST(coalesce(sum(length) OVER (ORDER BY page_id NULLS FIRST, sha256 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS BIGINT) AS "offset"
  FROM hashed WINDOW w AS (ORDER BY page_id NULLS FIRST, sha256)),
ranges AS (
  SELECT position // 64 AS range_no, sha256(string_agg(sha256, '' ORDER BY position)) AS range_sha256
  FROM placed GROUP BY position // 64)
SELECT position, page_id, "offset", length, sha256, range_no, range_sha256,
  CASE page_id % 1000 WHEN 17 THEN 'changed' WHEN 29 THEN 'missing' ELSE 'intact' END AS status
FROM placed JOIN ranges ON range_no = position // 64
"""


@query
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "impact-index")
    topk.write_vectors(table(spark, sf_dir, "embeddings"), f"{path}/vectors")
    vectors = spark.read.parquet(f"{path}/vectors")
    topk.write_index(vectors, f"{path}/blocks")
    found = topk.search(spark, f"{path}/blocks", vectors.filter("vec_id % 20 = 0"), 20, vectors)
    return found.select("query_id", "rank", "vec_id", "score")


ORACLES["op3_top_k"] = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.row <> b.row WHERE a.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digest(table(spark, sf_dir, "documents"))


# A crc is worked out byte by byte, with the usual table of the reflected polynomial.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384)) ORDER BY b) AS entry
  FROM range(256) AS t(b))"""


def _crc(text: str) -> str:
    digits = f"hex(encode({text}))"
    byte = f"CAST('0x' || substr({digits}, 2 * i + 1, 2) AS BIGINT)"
    each = f"list_transform(range(0, CAST(strlen({text}) AS BIGINT)), lambda i: {byte})"
    return f"""xor(list_reduce(list_prepend(4294967295, {each}),
    lambda crc, byte: xor(crc >> 8, entry[(xor(crc, byte) & 255) + 1])), 4294967295)"""


ORACLES["op11_sharding"] = f"""
WITH {_CRC_TABLE},
d AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size, coalesce(text, '') AS t,
    CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS key
  FROM documents),
p AS (
  SELECT *, CAST(sum(size) OVER (ORDER BY key, doc_id NULLS FIRST, t ROWS UNBOUNDED PRECEDING) AS BIGINT) AS done,
    row_number() OVER (ORDER BY key, doc_id NULLS FIRST, t) AS place, CAST(sum(size) OVER () AS BIGINT) AS every
  FROM d),
s AS (SELECT *, CAST(least(23, (2 * done - size) * 24 // (2 * every)) AS INTEGER) AS shard FROM p)
SELECT doc_id, size, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard,
  {_crc("t")} AS text_crc32
FROM s, crc_table
"""


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


def _clustering_sql(rounds: int = 3, k: int = 16, dims: int = 64) -> str:
    """Lloyd's rounds, one after the other; ``//`` rounds towards zero, so negative sums are moved below zero first."""
    near = """
a{i} AS MATERIALIZED (
  SELECT n, arg_min({{'c': c, 'd': d}}, d * {k} + c) AS best FROM (
    SELECT v.n, c.c, CAST(list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM v, c{i} AS c) GROUP BY n)"""
    move = """
c{j} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(m.q, c{i}.q) AS q FROM c{i} LEFT JOIN (
    SELECT c, list((s - CASE WHEN s < 0 THEN w - 1 ELSE 0 END) // w ORDER BY j) AS q FROM (
      SELECT a{i}.best.c AS c, j, CAST(sum(v.q[j]) AS BIGINT) AS s, count(*) AS w
      FROM v JOIN a{i} USING (n), range(1, {above}) AS t(j) GROUP BY 1, 2) GROUP BY c) AS m ON m.c = c{i}.c)"""
    parts = []
    for i in range(rounds):
        parts += [near.format(i=i, k=k), move.format(i=i, j=i + 1, above=dims + 1)]
    parts.append(near.format(i=rounds, k=k))
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS c, q FROM v
  QUALIFY c < {k}),
{",".join(parts)},
own AS (SELECT best.c AS c, CAST(sum(best.d) AS BIGINT) AS inertia FROM a{rounds} GROUP BY 1)
SELECT v.vec_id, CAST(a.best.c AS INTEGER) AS cluster, a.best.d AS distance, own.inertia AS cluster_inertia,
  CAST((SELECT sum(inertia) FROM own) AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM v JOIN a{rounds} AS a USING (n) JOIN c{rounds} AS c ON c.c = a.best.c JOIN own ON own.c = a.best.c
"""


ORACLES["op12_centroids"] = _clustering_sql()


@query
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.rows_of(table(spark, sf_dir, "conversations"))
    return conversations.repair_digest(conversations.damaged(rows))


# The grammar as its finite automaton: nothing read (0), a system turn (s), a pair opened (u) or closed (p). A recursive step reads
# one row from every state, after up to two insertions (a third leads nowhere new), and keeps the least (cost, edits) of each.
ORACLES["op13_conversations"] = f"""
WITH RECURSIVE {_CRC_TABLE},
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
harmed AS (SELECT conv_id, turn, role, text, {_crc("name")} % 20 AS harm FROM given, crc_table),
after AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM harmed, range(2) AS t(copy) WHERE harm <> 0 AND (copy = 0 OR harm = 3)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS seen,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM after)),
judged AS (
  SELECT conv_id, pos, turn, role, text, left(role, 1) AS i,
    CASE WHEN solid = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM numbered),
inserts AS (
  SELECT unnest(['0', 's', 'u', 'p', '0', 's', 'u', 'p', '0', 's', 'u', 'p']) AS a, unnest(['0', 's', 'u', 'p', 'u', 'u', 'p', 'u', 'p', 'p', 'u', 'p']) AS b,
    unnest([0, 0, 0, 0, 1, 1, 1, 1, 2, 2, 2, 2]) AS n),
reads AS (
  SELECT unnest(['0', '0', 's', 'p', 'u']) AS a, unnest(['s', 'u', 'u', 'u', 'a']) AS i, unnest(['s', 'u', 'u', 'u', 'p']) AS b),
moves AS (
  SELECT a, a AS b, 'D' AS e, NULL AS i, 2 AS cost FROM inserts WHERE n = 0
  UNION ALL SELECT a, b, 'K', i, 0 FROM reads
  UNION ALL SELECT a, b, 'R', NULL, 1 FROM reads WHERE i <> 's'),
turns AS (
  SELECT inserts.a, moves.b, repeat('I', CAST(n AS BIGINT)) || e AS edits, e, i, 5 * n + cost AS cost FROM inserts JOIN moves ON moves.a = inserts.b),
best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, '0' AS state, {{'cost': CAST(0 AS BIGINT), 'audit': ''}} AS way
  FROM (SELECT DISTINCT conv_id FROM given)
  UNION ALL
  SELECT r.conv_id, r.pos, m.b,
    min({{'cost': CAST(w.way.cost + m.cost + CASE WHEN r.fault = 'truncated' AND m.e <> 'D' THEN 5 ELSE 0 END AS BIGINT), 'audit': w.way.audit || m.edits}})
  FROM best AS w JOIN judged AS r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1 JOIN turns AS m ON m.a = w.state
  WHERE (m.i IS NULL OR m.i = r.i) AND (m.e = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
  GROUP BY r.conv_id, r.pos, m.b),
sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(i) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM judged) GROUP BY conv_id),
ends AS (
  SELECT best.conv_id, min({{'cost': CAST(way.cost + 5 * inserts.n AS BIGINT), 'audit': way.audit || repeat('I', CAST(inserts.n AS BIGINT))}}) AS way
  FROM best LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM best.conv_id JOIN inserts ON a = state AND b IN ('0', 'p')
  WHERE pos = coalesce(sums.n, 0) GROUP BY best.conv_id),
edits AS (SELECT conv_id, unnest(string_split(way.audit, '')) AS e, unnest(range(1, len(way.audit) + 1)) AS k FROM ends WHERE way.audit <> ''),
placed AS (SELECT *, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS pos FROM edits),
written AS (
  SELECT p.conv_id, k, e, CASE WHEN e = 'K' THEN r.i END AS i, r.role, CASE WHEN e = 'I' THEN '' ELSE r.text END AS text,
    row_number() OVER (PARTITION BY p.conv_id ORDER BY k) AS o
  FROM placed AS p LEFT JOIN judged AS r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.pos = p.pos WHERE e <> 'D'),
lines AS (
  SELECT conv_id, k, CASE WHEN e = 'K' THEN role WHEN (o - CASE WHEN system THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text AS line
  FROM (SELECT *, coalesce(first_value(i) OVER (PARTITION BY conv_id ORDER BY k) = 's', false) AS system FROM written)),
texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS text FROM lines GROUP BY conv_id)
SELECT ends.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, ends.way.cost AS cost, ends.way.audit AS audit,
  sha256(coalesce(texts.text, '')) AS repaired_sha256
FROM ends LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM ends.conv_id
LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM ends.conv_id
"""
