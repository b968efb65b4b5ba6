"""One query per operator, over the whole of its tables, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retain.llm import alignment, byte_bpe, chat, decontam, exact_dedup, langid, mixing, neardup, negatives, packing, pii, sharding, warc
from retain.llm.common import materialize, read, shared_path, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(read(spark, sf_dir, "documents"))


@query
def op2_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written matrices, read back: one row per sequence with the digest of its ids."""
    written = materialize(packing.pack(read(spark, sf_dir, "documents")), "packed")
    return written.withColumn("ids_sha256", F.sha2("input_ids", 256)).drop("input_ids")


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("words"), F.xxhash64("text").alias("text_hash")
    )
    mixed = mixing.mix(docs, F.col("words"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "mix.copies")


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(read(spark, sf_dir, "pages"), shared_path(spark, "warc"))
    return warc.report(warc.read(spark, files))


@query
def op5_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


@query
def op6_collapse_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(read(spark, sf_dir, "conversations"))


@query
def op7_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), percent=85, size=3)


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(spark, f"{sf_dir}/documents.parquet")


@query
def op9_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), n_shards=8)


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(read(spark, sf_dir, "documents"))


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.report(read(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.report(read(spark, sf_dir, "embeddings"))


ORACLE["op3_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws('|', 'mix', doc_id::VARCHAR)) AS line,
         CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS skey
  FROM documents
), s AS (
  SELECT skey, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY skey
), r AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         source_size::DOUBLE * 2 AS cap, sum(source_size) OVER ()::DOUBLE AS total
  FROM s
), l AS (
  SELECT *, (total * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r
), t AS (
  SELECT skey, source_size, least(cap, max(level) OVER () * weight) AS target FROM l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, d.line, d.skey,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END::DOUBLE AS rate,
         ('0x' || substr(md5('mix|' || d.skey), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift,
         row_number() OVER (PARTITION BY d.skey ORDER BY lpad(length(bin(d.size))::VARCHAR, 2, '0') || substr(bin(d.size), 1, 4),
                            ('0x' || substr(d.line, 1, 4))::INT % 1024, d.line, d.doc_id) AS place
  FROM d JOIN t USING (skey)
), c AS (
  SELECT *, (floor(place * rate + shift) - floor((place - 1) * rate + shift))::BIGINT AS copies FROM p
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""

ORACLE["op8_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""

ORACLE["op4_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
)
SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN strlen(body) >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(body) >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p
"""

ORACLE["op6_collapse_chats"] = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations
), l AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns,
         string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), ''
                    ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS rendered
  FROM t GROUP BY conv_id
), f AS (
  SELECT turns, min(conv_id) AS conv_id, count(*) AS copies, min(rendered) AS rendered FROM l GROUP BY turns
), p AS (
  SELECT DISTINCT list_slice(turns, 1, k) AS pre FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM l)
)
SELECT conv_id, len(turns) AS n_turns, copies, rendered FROM f WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pre = f.turns)
"""

ORACLE["op9_wu_manber"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, l.n, i, list_slice(w, i, i + l.n - 1) AS win
  FROM (SELECT d.doc_id, d.w, l.n, unnest(range(1, len(w) - l.n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) l WHERE len(w) >= l.n) l
), h AS (
  SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win
), hw AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY doc_id
), hi AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""

ORACLE["op13_hard_negatives"] = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, o.r, o.vec_id, a.label = o.label AS same,
         list_sum(list_transform(list_zip(a.q, o.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM e a JOIN e o ON a.r <> o.r WHERE a.vec_id % 100 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) AS nth FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.ar, p.nth ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
  WHERE p.nth <= 5
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
