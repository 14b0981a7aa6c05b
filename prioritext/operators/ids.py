"""Dense, gap-free row numbers per group without a single-task window.

``row_number() OVER (PARTITION BY split ORDER BY key)`` would put a whole
split into one task.  Instead the rows are range-partitioned on
``(split, key)`` (balanced by sampling), sorted inside each partition,
numbered locally and written once to the cluster's checkpoint folder; a tiny
table of per-partition counts (one row per partition and split) gives each
partition its offset.  Range bounds are sampled anew by every exchange, so
rows and counts must come from the same one: both read the written table,
and so does every later evaluation of the result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prioritext.operators.common import checked_broadcast
from prioritext.session import scratch_path

_PID_SHIFT = 33  # monotonically_increasing_id keeps the partition id above bit 33


def dense_index(
    df: DataFrame,
    group_col: str,
    order_col: str,
    out_col: str = "row_idx",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = 0-based position of the row within ``group_col`` by ``order_col``.

    ``order_col`` must be unique within a group for the numbering to be
    deterministic.  Rows with a null group are a group of their own.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, f"dense-index-{uuid.uuid4().hex}")
    (
        df.repartitionByRange(n, F.col(group_col), F.col(order_col))
        .sortWithinPartitions(group_col, order_col)
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_pos"), _PID_SHIFT))
        .write.parquet(path)
    )
    ranged = spark.read.parquet(path)
    per_part = ranged.groupBy(group_col, "_pid").agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first")
    )
    w = Window.partitionBy(group_col).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        F.col(group_col).alias("_og"),
        F.col("_pid").alias("_op"),
        (F.coalesce(F.sum("_cnt").over(w), F.lit(0)) - F.col("_first")).alias("_offset"),
    )
    # one row per (group, partition): bounded by the partition count
    same = F.col(group_col).eqNullSafe(F.col("_og")) & (F.col("_pid") == F.col("_op"))
    return (
        ranged.join(F.broadcast(offsets), same, "inner")
        .withColumn(out_col, (F.col("_offset") + F.col("_pos")).cast("bigint"))
        .drop("_pos", "_pid", "_og", "_op", "_offset")
    )


def file_order_index(scan: DataFrame, out_col: str = "row_idx") -> DataFrame:
    """Add ``out_col`` = 0-based position of the row in the Parquet files that ``scan`` reads, file after file.

    Map-only: a row's place in its file comes with the scan, and a file's
    offset from the lengths of the files before it, by path (one row a file,
    broadcast up to a checked bound).  Nothing is sorted or moved, and the
    same files give the same numbers whatever the tasks.
    """
    placed = scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    lengths = scan.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    lengths = lengths.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # over the files
    offsets = lengths.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    spark = scan.sparkSession
    path = scratch_path(spark, f"file-offsets-{uuid.uuid4().hex}")
    offsets.write.parquet(path)
    return (
        placed.join(checked_broadcast(spark.read.parquet(path)), "_file")
        .withColumn(out_col, (F.col("_offset") + F.col("_row")).cast("bigint"))
        .drop("_file", "_row", "_offset")
    )


def file_order_ids(splits: dict[str, DataFrame], split_col: str = "split", out_col: str = "id") -> DataFrame:
    """``"{split}-{i:06d}"`` ids, i the position in the files of the split; ``splits`` are Parquet scans."""
    parts = [
        file_order_index(scan, "_idx").withColumn(split_col, F.lit(name)).withColumn(out_col, F.format_string("%s-%06d", F.lit(name), "_idx"))
        for name, scan in splits.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop("_idx")


def dense_ids(
    df: DataFrame,
    split_col: str = "split",
    order_col: str = "doc_id",
    out_col: str = "id",
    num_partitions: int | None = None,
) -> DataFrame:
    """``"{split}-{i:06d}"`` ids, i dense per split in ``order_col`` order.

    ``format_string`` widens past six digits (``lpad`` would truncate).
    """
    idx = dense_index(df, split_col, order_col, "_idx", num_partitions)
    return idx.withColumn(out_col, F.format_string("%s-%06d", F.col(split_col), F.col("_idx"))).drop("_idx")
