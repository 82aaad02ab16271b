"""The registered queries of the operators, with their production parameters, and SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm import negatives
from tiermill.llm.common import table
from tiermill.llm.decontaminate import contaminated
from tiermill.llm.html_text import visible_text
from tiermill.llm.packing import pack
from tiermill.llm.quality import quality_scores
from tiermill.llm.secrets import secrets
from tiermill.llm.sharding import shard_by_bytes
from tiermill.llm.simhash import simhash_components
from tiermill.llm.substring import repeated_passages
from tiermill.llm.topk import scaled, top_inner_products
from tiermill.llm.toxicity import toxicity
from tiermill.llm.trie import placed_turns, prefix_trie, with_heads
from tiermill.llm.warc import convert_arc, read_warc, with_referred_page, write_arc, write_warc
from tiermill.session import new_path, written

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("text_md5")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_md5")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd pages go through ARC version 1 and even ones through version 2."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    arc, folder = new_path(spark, "arc"), new_path(spark, "warc")
    even = F.coalesce(F.col("page_id") % 2 == 0, F.lit(True))
    write_arc(pages.filter(~even), f"{arc}/v1", version=1)
    write_arc(pages.filter(even), f"{arc}/v2", version=2)
    write_warc(convert_arc(spark, arc), folder, 0, convert_arc(spark, arc, payloads=False))
    records = written(read_warc(spark, folder, payloads=False), "warc-records")
    return with_referred_page(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaled(table(spark, sf_dir, "embeddings"), 256)
    return top_inner_products(vectors, vectors.filter("vec_id % 50 = 0"), 5)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visible_text(table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), shards=40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), length=4096)
    return packed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations of five begin with the first turns of the first of them, 8 at most."""
    conversations = table(spark, sf_dir, "conversations")
    turns = written(placed_turns(conversations), "placed-turns")
    base = F.expr("conv_id - conv_id % 5")
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return prefix_trie(with_heads(turns, base, heads, most=8), turns.select("conv_id"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row gets the next label first; every hundredth is an anchor."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(negatives.scaled(rows), F.col("vec_id") % 100 == 0)


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents")).drop("base")


QUERIES: dict[str, Query] = {
    "op1_substring": op1_substring,
    "op2_decontamination": op2_decontamination,
    "op3_quality": op3_quality,
    "op4_warc": op4_warc,
    "op5_topk": op5_topk,
    "op6_toxicity": op6_toxicity,
    "op7_html": op7_html,
    "op8_simhash": op8_simhash,
    "op9_sharding": op9_sharding,
    "op10_packing": op10_packing,
    "op11_trie": op11_trie,
    "op12_negatives": op12_negatives,
    "op13_secrets": op13_secrets,
}

ORACLES: dict[str, str] = {
    # DuckDB has no CRC-32; it is reckoned bit by bit, eight bits for each digit of the id.
    "op11_trie": """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), listed AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS own FROM turns GROUP BY conv_id
), headed AS (
  SELECT conv_id, own, xor(4294967295, list_reduce(
           list_prepend(4294967295, range(0, 8 * len(CAST(conv_id AS VARCHAR)))),
           lambda crc, i: CASE WHEN i % 8 > 0
             THEN CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END
             ELSE CASE WHEN xor(crc, ascii(substr(CAST(conv_id AS VARCHAR), 1 + CAST(i // 8 AS INT), 1))) & 1 = 1
               THEN xor(xor(crc, ascii(substr(CAST(conv_id AS VARCHAR), 1 + CAST(i // 8 AS INT), 1))) >> 1,
                        3988292384)
               ELSE xor(crc, ascii(substr(CAST(conv_id AS VARCHAR), 1 + CAST(i // 8 AS INT), 1))) >> 1 END
             END)) % 9 AS h
  FROM listed
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) AS seq
  FROM headed a LEFT JOIN listed b ON b.conv_id = a.conv_id - a.conv_id % 5
), prefixes AS (
  SELECT conv_id, seq[1:d] AS prefix, d, d = len(seq) AS ends
  FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT prefix, d, CASE WHEN d > 0 THEN prefix[1:d - 1] END AS parent, min(conv_id) AS conv_id,
         count(*) AS n, CASE WHEN d > 0 THEN strlen(prefix[d].text) ELSE 0 END AS size,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ended
  FROM prefixes GROUP BY prefix, d
), children AS (
  SELECT parent AS prefix, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent
), counted AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix)
), above AS (
  SELECT prefix[1:k] AS prefix, n_children = 0 AS is_leaf, (n - 1) * size AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM counted)
), sums AS (
  SELECT prefix, count(*) FILTER (is_leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM above GROUP BY prefix
)
SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n AS n_convs, c.n_children, n_leaves,
       saved_tokens, sha256(c.ended) AS ends_sha256
FROM counted c JOIN sums ON sums.prefix = c.prefix LEFT JOIN nodes p ON p.prefix = c.parent""",
    "op12_negatives": """
WITH numbered AS (
  SELECT row_number() OVER () AS row, vec_id, embedding,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), vectors AS (
  SELECT row, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
  FROM numbered
), scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS alike,
         CAST(list_dot_product(a.vector, b.vector) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.row <> b.row AND len(a.vector) = len(b.vector)
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) <= 5
), ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
         p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor, p.row
                                 ORDER BY n.score DESC, n.vec_id, n.row) AS INT) AS rank
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.alike
   AND 80 * p.score <= 100 * n.score AND n.score <= p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5""",
}
