"""Balanced contiguous shards from global byte prefix sums (DataFrame only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import materialize, parts_of

OVERHEAD = 16


def shard_by_bytes(docs: DataFrame, shards: int = 40, overhead: int = OVERHEAD) -> DataFrame:
    """Put every row in one of `shards` contiguous ranges of doc_id order whose
    sizes (UTF-8 bytes of text plus `overhead`) are near equal.

    Slim rows are range-partitioned and written once, so that block numbers are
    fixed; block totals give each block its offset, a window inside each block
    gives the running size, and a row goes where the middle of its bytes falls
    between equal targets. No shard differs from the target by more than its
    two border rows.

    Law `bytes`; grown_shard is null. Null text has only the overhead, null
    doc_id sorts first, repeated rows each get a slot of their own (ties are
    broken by checksum, then by a fixed salt), an empty table gives no rows.
    Columns other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + F.lit(overhead)).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    ).withColumn("salt", F.rand(17))
    keys = ["doc_id", "text_crc32", "salt"]
    blocks = slim.repartitionByRange(max(2, parts_of(spark)), *keys).withColumn("block", F.spark_partition_id())
    rows = materialize(blocks, "shard-rows")

    inside = Window.partitionBy("block").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("bytes_in"),
        F.count("*").over(inside).alias("rows_in"),
    )
    # one row for each block: as many as partitions, whatever the data
    per_block = rows.groupBy("block").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(
        "block",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("bytes_to"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_to"),
        F.sum("size").over(Window.partitionBy()).alias("total"),
    )
    placed = rows.join(F.broadcast(offsets), "block").select(
        "doc_id", "size", "text_crc32",
        (F.col("rows_in") + F.col("rows_to")).alias("at"),
        F.least(
            F.lit(shards - 1).cast("long"),
            F.expr(f"(2 * (bytes_in + bytes_to) + size) * {shards} div (2 * total)"),
        ).cast("int").alias("shard"),
    )
    # one row for each shard
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("at") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
