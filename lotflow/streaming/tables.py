"""Tables written by streaming queries: one folder per batch, and a commit once it is whole.

A batch that runs again overwrites its own folder, so every write is idempotent. Readers see
batches up to the last commit only, so they never meet a half-written one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_batch(batch: DataFrame, batch_id: int, path: str, partition_by: str | None = None) -> None:
    """Writes a batch in full, with as many files as the batch has partitions, then commits it."""
    writer = batch.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{path}/data/batch_id={batch_id}")
    _commit(batch.sparkSession, batch_id, path)


def _commit(spark: SparkSession, batch_id: int, path: str) -> None:
    done = spark.range(1).select(F.lit(batch_id).cast("long").alias("batch"))
    done.write.mode("overwrite").parquet(f"{path}/commits/{batch_id:012d}")


def last_commit(spark: SparkSession, path: str) -> int | None:
    """The newest whole batch; one row comes back to the driver."""
    try:
        commits = spark.read.schema("batch long").option("recursiveFileLookup", "true").parquet(f"{path}/commits")
    except AnalysisException:
        return None
    return commits.agg(F.max("batch")).first()[0]


def read_latest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest version of a table that each batch writes anew; empty before the first."""
    last = last_commit(spark, path)
    if last is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/data/batch_id={last}")


def read_all(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All committed batches of a table that each batch adds to, with ``batch_id``.

    Where the table was compacted, the compacted rows stand for the batches they came from, whose
    folders are not read.
    """
    with_id = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    last = last_commit(spark, path)
    if last is None:
        return spark.createDataFrame([], with_id)
    batch = F.col("batch_id")
    rows = spark.read.schema(with_id).option("basePath", f"{path}/data").parquet(f"{path}/data").where(batch <= last)
    compacted = last_commit(spark, f"{path}/compacted")
    if compacted is None:
        return rows
    base = spark.read.schema(with_id).parquet(f"{path}/compacted/rows/upto={compacted}")
    return base.unionByName(rows.where(batch > compacted).select(*base.columns))


def compact(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], *then: str, apart: str | None = None
) -> None:
    """Folds the update log into one row per key, so that reading it does not grow with its age.

    Rows for which the expression ``apart`` has a value are results in their own right: one is kept per key and value.
    """
    last = last_commit(spark, path)
    if last is None:
        return
    rows = read_all(spark, path, schema)
    values = [name for name in rows.columns if name not in keys]
    groups = keys if apart is None else [*keys, F.expr(apart).alias("_apart")]
    newest = rows.groupBy(*groups).agg(F.max_by(F.struct(*values), F.struct("batch_id", *then)).alias("row"))
    newest.select(*keys, "row.*").write.mode("overwrite").parquet(f"{path}/compacted/rows/upto={last}")
    _commit(spark, last, f"{path}/compacted")


def latest_per_key(rows: DataFrame, keys: list[str], *then: str) -> DataFrame:
    """Of each key the row of the newest batch (and greatest ``then``): an update log as a table."""
    values = [name for name in rows.columns if name not in keys and name != "batch_id"]
    newest = F.max_by(F.struct(*values), F.struct("batch_id", *then))
    return rows.groupBy(*keys).agg(newest.alias("row")).select(*keys, "row.*")
