"""Contiguous byte-balanced shards (operator 9).

Documents are put in one global order, range-partitioned by it. Every range
partition gives one row of totals; prefix sums over that small table turn the
positions inside a partition into global byte and row positions, and the byte
axis is cut at equal targets. A document belongs to the shard in which the
middle of its bytes falls, so a shard misses its target by at most one
document at either end.

Defined cases: a null text has size 1 and checksum 0; null ids sort first;
rows that repeat an id, or a whole row, are rows of their own and tie in any
order; an empty table gives no rows; a document larger than a whole target
leaves neighbouring shards short or empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nbsieve.llm.common import stored

SHARDS = 8


def byte_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs``."""
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = stored(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row")), "shard-sizes")
    order = ["doc_id", "text_crc32", "size", "row"]
    ranged = stored(rows.repartitionByRange(*order)
                    .withColumn("part", F.spark_partition_id()), "shard-ranges")

    # One row per range partition; this window never sees more rows than that.
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"),
                                        F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("byte_offset"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("row_offset"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"))

    inside = Window.partitionBy("part").orderBy(*order)
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = (ranged
              .withColumn("upto", upto)
              .withColumn("nth", F.row_number().over(inside))
              .join(F.broadcast(offsets), "part")
              .withColumn("twice_middle", 2 * (F.col("byte_offset") + F.col("upto"))
                          - F.col("size"))
              .select("doc_id", "size", "text_crc32",
                      F.least(F.lit(shards - 1),
                              F.expr(f"twice_middle * {shards} div (2 * all_bytes)"))
                      .cast("int").alias("shard"),
                      (F.col("row_offset") + F.col("nth") - 1).alias("position")))
    placed = stored(placed, "shard-placed")
    starts = placed.groupBy("shard").agg(F.min("position").alias("first"))
    return (placed.join(F.broadcast(starts), "shard")  # at most one row per shard
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("position") - F.col("first")).alias("slot")))


def op9_byte_shards(docs: DataFrame) -> DataFrame:
    return byte_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
