"""Sharding by jump consistent hashing.

A key walks through buckets 0, 1, 2, ... by jumps whose lengths are drawn from the key itself;
the last bucket below the number of shards is its shard.  There is no table of shards, and a
further shard only takes rows into itself, because the walk up to there stays the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered

LAW = "key"


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a string ``key`` (null counts as the text 'null'), from 0 to ``shards`` - 1.

    A draw is the first 32 bits of md5(key:bucket), in (0, 1].  From bucket b the next bucket is
    floor((b + 1) / draw), which is the law of the method; it takes ln(shards) steps on average.
    The fold has ``shards`` steps, the most there can be, and the ones left over do nothing.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    key = F.coalesce(key, F.lit("null"))

    def step(walk: Column, _: Column) -> Column:
        at = walk["next"]
        digest = F.md5(F.concat(key, F.lit(":"), at.cast("string")))
        draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
        following = F.floor((at + 1) * F.lit(4294967296.0) / (draw + 1))
        return F.when(
            at < shards, F.struct(at.alias("bucket"), following.alias("next"))
        ).otherwise(walk)

    start = F.struct(F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("next"))
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)
    return walk["bucket"].cast("int")


def shard(
    df: DataFrame, key: str, shards: int, tie: list[str] | None = None
) -> DataFrame:
    """Add ``shard``, ``grown_shard`` (with one more shard) and ``slot`` to every row.

    ``slot`` is the gapless place in the shard, from 0, by ``key`` (null first) and the columns
    ``tie``; equal rows get different slots in any order.  Only the key decides the shard: equal keys
    stay together and null keys share one shard.  Input columns with the three names are
    replaced.  An empty table gives an empty result.
    """
    text = F.col(key).cast("string")
    placed = df.withColumns(
        {"shard": jump_shard(text, shards), "grown_shard": jump_shard(text, shards + 1)}
    ).drop("slot")
    return numbered(placed, ["shard"], [key, *(tie or [])], "slot")


def describe(documents: DataFrame) -> DataFrame:
    """doc_id, ``size`` (bytes of the text and 1) and ``text_crc32``; a null text has no bytes."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )


def sharded(documents: DataFrame, shards: int = 8) -> DataFrame:
    """The documents with shard, grown_shard and slot; equal ids are told apart by their texts."""
    summed = documents.withColumn("_llm_crc", F.crc32(F.col("text")))
    return shard(summed, "doc_id", shards, ["_llm_crc"]).drop("_llm_crc")


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in eight shards, with digest columns."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    placed = shard(describe(documents), "doc_id", 8, ["text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard"
    )


SQL = r"""
WITH RECURSIVE poly AS (
  SELECT i, i::UBIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1
  FROM poly WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS cs FROM poly WHERE k = 8),
body AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents
),
spelled AS (
  SELECT r, doc_id, octet_length(b) AS n,
    list_transform(
      list_filter(string_split(regexp_replace(hex(b), '(..)', '\1,', 'g'), ','), lambda x: x <> ''),
      lambda x: ('0x' || x)::UBIGINT) AS bytes
  FROM body
),
summed AS (
  SELECT r, doc_id, (n + 1)::BIGINT AS size,
    xor(list_reduce(
      list_concat([4294967295::UBIGINT], bytes),
      lambda c, x: xor(c >> 8, cs[(xor(c, x) & 255)::INT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM spelled, crc_table
),
walk AS (
  SELECT r, coalesce(doc_id::VARCHAR, 'null') AS key, 0::BIGINT AS bucket, 0::BIGINT AS nxt
  FROM summed
  UNION ALL
  SELECT r, key, nxt, floor((nxt + 1) * 4294967296.0::DOUBLE
      / (('0x' || substr(md5(key || ':' || nxt::VARCHAR), 1, 8))::BIGINT + 1))::BIGINT
  FROM walk WHERE nxt < 9
),
placed AS (
  SELECT r, max(bucket) FILTER (bucket < 8)::INTEGER AS shard, max(bucket)::INTEGER AS grown_shard
  FROM walk GROUP BY r
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
  grown_shard
FROM summed JOIN placed USING (r)
"""
