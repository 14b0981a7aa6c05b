"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass 1 scatters the records over memory-sized buckets by a seeded hash of id,
text and place in the input, and writes them with their buckets; pass 2 brings each
bucket to a partition of its own, collects it, puts it into a Fisher-Yates order
(Spark's ``shuffle`` of an array) and deals it to the shards.  A bucket's
place in the whole is the number of records in the buckets before it, so
record p of the whole goes to slot ``p // shards`` of shard ``p % shards``:
the law ``rows``, counts at most one apart.

Equal records scatter independently, however many there are.  The bucket count
follows the input's bytes.

Defined results
  null text: size 1 and the CRC-32 of no bytes; null id: hashed as such;
  repeated rows: each takes a slot of its own;
  empty or very long text: one record like any other; empty table: no rows;
  extra columns travel inside the record and may have any name and any type that sorts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prioritext.llm.tables import table, written

BUCKET_BYTES = 32 << 20
SHARDS = 8
SEED = 20_240_601


def external_shuffle(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(record, size, shard, slot)``: each row of ``docs`` as a struct, with its place.

    The same seed, input and layout give the same order.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(F.col(id_col).alias("id"), F.crc32(text).alias("crc"), F.struct(*docs.columns).alias("record")).alias("r"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    n = max(1, -(-total // bucket_bytes))
    # the place makes equal records differ; it is written, so that every later reading sees the same bucket
    place = F.monotonically_increasing_id()
    spot = F.pmod(F.xxhash64(F.lit(seed), F.col("r.id").isNull(), "r.id", "r.crc", place), F.lit(n)).cast("int")
    scattered = written(rows.select(spot.alias("bucket"), F.struct("r", "size").alias("row")), "scattered")
    buckets = (
        scattered.repartitionById(n, F.col("bucket"))
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list("row")).alias("rows"))
        .select("bucket", F.posexplode(F.shuffle("rows", seed)).alias("place", "row"))
    )
    # one row per bucket: broadcast, so that the records cross the network once only
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    at = F.col("offset") + F.col("place")
    return buckets.join(F.broadcast(offsets), "bucket").select(
        F.col("row.r.record").alias("record"),
        F.col("row.size").alias("size"),
        F.pmod(at, F.lit(shards)).cast("int").alias("shard"),
        F.floor(at / shards).cast("long").alias("slot"),
    )


def write_shards(shuffled: DataFrame, path: str) -> None:
    """The records as Parquet, one folder per shard, in order of their slots within a file."""
    shuffled.select("record.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot")).sortWithinPartitions(
        "_shard", "_slot"
    ).write.partitionBy("_shard").parquet(path)


def op7_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to eight shards with equal row counts."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return external_shuffle(docs).select(
        F.col("record.doc_id").alias("doc_id"),
        "size",
        F.crc32(F.coalesce("record.text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
