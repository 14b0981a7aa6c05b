"""Seeded, partition-independent sampling and splitting.

Every draw is a hash of ``(seed, key)``, never ``rand()``: the same seed and
data give the same result for any partitioning.  ``hash60`` is the first
60 bits of an MD5 digest, which DuckDB reproduces exactly.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prioritext.constants import DEFAULT_SEED, TEST_SIZE, VALID_LABELS
from prioritext.operators.common import EngineError
from prioritext.operators.ids import dense_index
from prioritext.session import scratch_path

# Bits of the 60-bit hash kept by the split's bucket (the rest rank inside).
_BUCKET_SHIFT = 40


def hash60(seed: int, key: F.Column | str) -> F.Column:
    """Unsigned 60-bit hash of ``'{seed}-{key}'`` as BIGINT."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}-"), k.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def largest_remainder_quotas(counts: dict[str, int], n_take: int) -> dict[str, int]:
    """Integer quotas proportional to ``counts`` summing to ``n_take``.

    Floors first, then the remainder goes to the largest fractional parts
    (exact integer arithmetic), ties by label.
    """
    total = sum(counts.values())
    if total == 0:
        return {k: 0 for k in counts}
    base = {k: (c * n_take) // total for k, c in counts.items()}
    rem = {k: (c * n_take) % total for k, c in counts.items()}
    left = n_take - sum(base.values())
    for k in sorted(counts, key=lambda x: (-rem[x], x))[:left]:
        base[k] += 1
    return base


def stratified_split(
    df: DataFrame,
    label_col: str = "label",
    id_col: str = "doc_id",
    test_size: float = TEST_SIZE,
    seed: int = DEFAULT_SEED,
    out_col: str = "split",
) -> DataFrame:
    """Exact stratified split: ``ceil(test_size * n)`` test rows, class
    proportions kept by largest remainder, the quota of smallest hashes per class.

    The input is read once for a narrow table of class, hash and id, written so
    that counts and cuts come from the same rows.  There, classes are counted per
    ``hash >> 40`` bucket, the bucket that holds a class's cut is ranked alone
    (never a whole class), and the last test row of each class reaches the driver
    (k rows).  Rows are then told apart map-only, against k literals.

    A null label or a null id raises.  Rows of one id and class go to the same
    side, so repeated ids may make a quota larger by their repeats.
    """
    if label_col not in df.columns:
        raise EngineError(f"stratified_split: no column {label_col!r} to stratify by among {df.columns}")
    spark = df.sparkSession
    narrow = df.select(F.col(label_col).alias("label"), F.col(id_col).alias("id"), hash60(seed, id_col).alias("h"))
    path = scratch_path(spark, f"split-{uuid.uuid4().hex}")
    narrow.write.parquet(path)
    narrow = spark.read.schema(narrow.schema).parquet(path).withColumn("bucket", F.shiftright("h", _BUCKET_SHIFT))

    per_class = narrow.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("id").isNull()).alias("no_id"))
    rows = per_class.collect()  # one row per class
    for what, lost in (("label", sum(r["n"] for r in rows if r["label"] is None)), ("id", sum(r["no_id"] for r in rows))):
        if lost:
            raise EngineError(f"stratified_split: {lost} rows have no {what}, give them one or leave them out first")
    counts = {r["label"]: int(r["n"]) for r in rows}
    small = sorted(k for k, c in counts.items() if c < 2)
    if small:
        raise EngineError(f"stratified_split: classes {small} have fewer than 2 rows")
    quotas = largest_remainder_quotas(counts, math.ceil(test_size * sum(counts.values())))
    quotas = {k: q for k, q in quotas.items() if q > 0}
    if not quotas:
        return df.withColumn(out_col, F.lit("train"))

    quota_of = F.create_map(*[x for k, q in quotas.items() for x in (F.lit(k), F.lit(q))])
    upto = Window.partitionBy("label").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        narrow.groupBy("label", "bucket")
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn("cum", F.sum("c").over(upto))
        .withColumn("need", quota_of[F.col("label")] - F.col("cum") + F.col("c"))
        .filter((F.col("need") > 0) & (F.col("need") <= F.col("c")))
        .select("label", "bucket", "need")
    )
    inside = narrow.join(F.broadcast(cuts), ["label", "bucket"]).groupBy("label", "need", "h", "id").agg(F.count(F.lit(1)).alias("c"))
    ranked = inside.withColumn("cum", F.sum("c").over(Window.partitionBy("label").orderBy("h", "id")))
    last = (
        ranked.filter(F.col("cum") >= F.col("need")).groupBy("label").agg(F.min(F.struct("h", "id")).alias("cut")).collect()
    )  # one row per class

    h, key = hash60(seed, id_col), F.col(id_col)
    in_test = F.lit(False)
    for r in last:
        before = (h < r["cut"]["h"]) | ((h == r["cut"]["h"]) & (key <= F.lit(r["cut"]["id"])))
        in_test = in_test | ((F.col(label_col) == F.lit(r["label"])) & before)
    return df.withColumn(out_col, F.when(in_test, F.lit("test")).otherwise(F.lit("train")))


def sample_with_replacement(
    pool: DataFrame,
    n: int,
    seed: int = DEFAULT_SEED,
    order_col: str = "doc_id",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """``n`` seeded draws with replacement: slot -> ``hash(seed, slot) % pool_n``
    -> row of that dense index.  ``n`` may exceed the pool; empty pool -> error."""
    spark = pool.sparkSession
    pool_n = pool.count()
    if pool_n == 0:
        raise EngineError("cannot sample from an empty pool")
    indexed = dense_index(pool.withColumn("_g", F.lit(0)), "_g", order_col, "_idx").drop("_g")
    slots = spark.range(n).withColumnRenamed("id", "slot").withColumn("_idx", hash60(seed, F.col("slot")) % F.lit(pool_n))
    return slots.join(indexed.select("_idx", *keep), "_idx", "inner").drop("_idx")


def sample_without_replacement(df: DataFrame, n: int, seed: int = DEFAULT_SEED, id_col: str = "doc_id") -> DataFrame:
    """``n`` distinct rows with the smallest seeded hashes (TakeOrdered, no full sort)."""
    return (
        df.withColumn("_h", hash60(seed, F.col(id_col)))
        .orderBy("_h", id_col)
        .limit(n)
        .drop("_h")
    )


def warmup_split(df: DataFrame, warmup: int, slot_col: str = "slot") -> DataFrame:
    """Tag the first ``warmup`` slots as warm-up, the rest as measured."""
    return df.withColumn("phase", F.when(F.col(slot_col) < warmup, F.lit("warmup")).otherwise(F.lit("measured")))


def balanced_mix(
    df: DataFrame,
    n: int,
    seed: int = DEFAULT_SEED,
    label_col: str = "label",
    id_col: str = "doc_id",
    labels: Sequence[str] = VALID_LABELS,
) -> DataFrame:
    """``n`` draws spread evenly over the classes, then shuffled.

    ``n // k`` draws (at least 1) per present class in alphabetical order,
    each a hash into the class's dense index; the shortfall to ``n`` is
    filled by redrawing from those base picks; the list is cut to ``n``;
    ``order_key`` (a seeded hash of the position) gives the shuffled order.
    Slots are generated by ``spark.range`` and joined to the pool: nothing
    passes through the driver except the per-class counts.
    """
    if n <= 0:
        raise ValueError(f"balanced_mix: a mix of {n} rows cannot be drawn, ask for one at least")
    spark = df.sparkSession
    classes = sorted(labels)
    rows = df.filter(F.col(label_col).isin(classes)).groupBy(label_col).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r[label_col]: int(r["n"]) for r in rows}
    present = [c for c in classes if counts.get(c, 0) > 0]
    if not present:
        raise ValueError(f"balanced_mix: none of {classes} occurs in {label_col!r}")
    take = max(1, n // len(classes))
    base_len = take * len(present)

    pool = dense_index(df.filter(F.col(label_col).isin(present)), label_col, id_col, "_idx")
    cls_arr = F.array(*[F.lit(c) for c in present])
    cnt_map = F.create_map(*[x for c in present for x in (F.lit(c), F.lit(counts[c]))])
    base = (
        spark.range(base_len)
        .withColumnRenamed("id", "pos")
        .withColumn(label_col, F.element_at(cls_arr, (F.col("pos") / take).cast("int") + 1))
        .withColumn("_j", F.col("pos") % take)
        .withColumn(
            "_idx",
            hash60(seed, F.concat(F.col(label_col), F.lit("-"), F.col("_j").cast("string"))) % cnt_map[F.col(label_col)],
        )
        .join(pool.select(label_col, "_idx", id_col), [label_col, "_idx"], "inner")
        .select("pos", label_col, id_col)
    )
    picks = base.filter(F.col("pos") < n)
    if base_len < n:
        top = (
            spark.range(base_len, n)
            .withColumnRenamed("id", "pos")
            .withColumn("_src", hash60(seed, F.concat(F.lit("top-"), F.col("pos").cast("string"))) % F.lit(base_len))
        )
        src = base.select(F.col("pos").alias("_src"), label_col, id_col)
        picks = picks.unionByName(top.join(src, "_src", "inner").select("pos", label_col, id_col))
    return picks.withColumn("order_key", hash60(seed, F.concat(F.lit("mix-"), F.col("pos").cast("string"))))
