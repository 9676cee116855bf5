"""Sharding: contiguous shards of nearly equal bytes, cut out of a global prefix sum.

Only (id, size, checksum) is sorted. Each range partition is summed, the few partition totals are
accumulated, and every row adds its partition's start to its running sum. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeline.llm.frames import id_key
from gradeline.sources.tables import keep

SHARDS = 16


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id", extra: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, *extra): shards in the order of the id.

    A row's size is the UTF-8 length of its text plus 1, so NULL and empty texts have size 1. A row
    belongs to the shard in which the middle of its bytes falls when the whole is cut into equal
    targets; shards differ from the target by less than one row. Slots count the rows of a shard from
    0 in the order of the id. The law is ``bytes``, under which one more shard would move rows
    everywhere, so grown_shard is NULL.

    Rows that repeat an id lie side by side in any order; rows without id come last. A shard can stay
    empty where a row is larger than a target or the table is empty. All equal ids may
    exceed one partition: a row number assigned when the table is first read splits them.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    sized = keep(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(t) + F.lit(1).cast("long")).alias("size"),
            F.crc32(t).alias("text_crc32"), id_key(doc_id).alias("_id"),
            F.monotonically_increasing_id().alias("_row"), *[F.col(f"`{c}`") for c in extra],
        ),
        "sized",
    )
    ranged = keep(sized.repartitionByRange("_id", "_row").withColumn("_part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of this job, so both the window and the broadcast are bounded by its number.
    starts = F.broadcast(
        totals.select(
            "_part", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_start"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"),
            F.sum("_bytes").over(Window.partitionBy()).alias("_all"),
        )
    )
    inside = Window.partitionBy("_part").orderBy("_id", "_row")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = (
        ranged.withColumns({"_end": running, "_number": F.row_number().over(inside)})
        .join(starts, "_part")
        .withColumn("_middle", 2 * (F.col("_start") + F.col("_end")) - F.col("size"))
        .withColumn("shard", F.expr(f"least({shards - 1}, (_middle * {shards}) div (2 * _all))").cast("int"))
        .withColumn("_number", F.col("_first") + F.col("_number") - 1)
    )
    placed = keep(placed, "placed")
    # One row per shard.
    firsts = F.broadcast(placed.groupBy("shard").agg(F.min("_number").alias("_shard_first")))
    return placed.join(firsts, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_number") - F.col("_shard_first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *extra,
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id") -> None:
    """The texts as folders ``shard=0`` and so on, rows in slot order within each file."""
    placed = assign_shards(docs, shards, text, doc_id, (text,) if text not in ("doc_id", "size") else ())
    ordered = placed.hint("rebalance", "shard").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)


REPORT_SQL = f"""
WITH RECURSIVE steps AS (
  SELECT range AS byte, range AS value, 0 AS step FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, step + 1 FROM steps WHERE step < 8),
crc AS (SELECT list(value ORDER BY byte) AS t FROM steps WHERE step = 8),
sized AS (
  SELECT doc_id, CAST(octet_length(b) + 1 AS BIGINT) AS size,
    xor(4294967295, list_reduce(list_transform(regexp_extract_all(h, '..'), lambda x: CAST('0x' || x AS BIGINT)),
      lambda c, x: xor(c >> 8, t[1 + xor(c & 255, x)]), 4294967295)) AS text_crc32
  FROM (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS h FROM documents), crc),
placed AS (
  SELECT *, least({SHARDS - 1}, ((2 * ends - size) * {SHARDS}) // (2 * total)) AS shard
  FROM (SELECT *, sum(size) OVER (ORDER BY doc_id) AS ends, sum(size) OVER () AS total FROM sized))
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INT) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
FROM placed"""
