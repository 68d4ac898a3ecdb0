"""Contiguous shards of near equal bytes, from a distributed prefix sum."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycrest.session import materialize

SHARDS = 16


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    Documents are ordered by id. Each range of ids adds up its sizes; the running sum of
    these totals gives every range its offset, so a document's byte offset in the whole
    corpus is known without a global sort in one task. A document belongs to the shard in
    which its middle byte falls when the corpus is cut into ``shards`` equal targets, so a
    shard is off by at most one document's size. ``slot`` counts from 0 inside a shard.

    Size is the text's UTF-8 bytes plus 1 (null text: 1, checksum of no bytes). Null ids come
    first; rows with equal ids are ordered by checksum and size, and equal rows are
    interchangeable. An empty table gives no rows. Other columns of ``docs`` are not read.
    Only ids, sizes and checksums are shuffled, never a text.
    """
    order = ["doc_id", "text_crc32", "size"]
    text = F.coalesce(F.col("text"), F.lit(""))
    sizes = materialize(
        docs.select(
            "doc_id",
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        ),
        "shard-sizes",
    )
    # the range of each row is written, so all later passes agree on it
    ranged = materialize(
        sizes.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shard-ranges"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    parts = (
        ranged.groupBy("part")
        .agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
        .select(
            "part",
            F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("byte_base"),
            F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("row_base"),
            F.sum("part_bytes").over(everything).alias("total"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # one row per range partition: bounded by the number of shuffle partitions
    placed = (
        ranged.withColumn("run", F.sum("size").over(inside))
        .withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
        .join(F.broadcast(parts), "part")
        .withColumn("start", F.col("byte_base") + F.col("run") - F.col("size"))
        .withColumn("row", F.col("row_base") + F.col("nth") - 1)
        .withColumn(
            "shard",
            F.expr(f"CAST(LEAST({shards} - 1, ((2 * start + size) * {shards}) DIV (2 * total)) AS INT)"),
        )
    )
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot")
    )
