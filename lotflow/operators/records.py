"""Completeness of a record stream: which offsets of which partition never came.

Offsets that follow each other form an island. Islands are found block by block of offsets, so that a topic with few
partitions still spreads over the cluster, and what meets by partition afterwards is a row per island and not per record.
Islands of several batches add up: their union, joined, gives the islands of all records, in whatever order the
batches came and however often a record was sent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets of a block.
BLOCK = 1 << 20


def islands(records: DataFrame) -> DataFrame:
    """Rows (partition, first_offset, last_offset) of runs of offsets, cut at the ends of blocks; records without an offset have no part."""
    block = F.expr(f"offset div {BLOCK}").alias("block")
    rows = records.where("offset IS NOT NULL").select(F.coalesce(F.col("partition").cast("int"), F.lit(0)).alias("partition"), "offset", block)
    in_order = Window.partitionBy("partition", "block").orderBy("offset")
    starts = F.coalesce(F.col("offset") - F.lag("offset").over(in_order) > 1, F.lit(True)).cast("int")
    numbered = rows.withColumn("starts", starts).withColumn("island", F.sum("starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    found = numbered.groupBy("partition", "block", "island").agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
    return found.select("partition", "first_offset", "last_offset")


def gaps(found: DataFrame) -> DataFrame:
    """Rows (partition, first_missing, last_missing, missing) between the islands; islands may overlap or repeat."""
    before = Window.partitionBy("partition").orderBy("first_offset", "last_offset").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max("last_offset").over(before)
    behind = found.select("partition", "first_offset", reached.alias("reached")).where(F.col("first_offset") > F.col("reached") + 1)
    first, last = F.col("reached") + 1, F.col("first_offset") - 1
    return behind.select("partition", first.alias("first_missing"), last.alias("last_missing"), (last - first + 1).alias("missing"))
