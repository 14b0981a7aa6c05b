"""Collapse of cumulative conversation snapshots, then rendering; DataFrame operations only.

Every turn gets the rolling hash of its conversation up to it (two sums of 40
bits over position, role and text).  A conversation is dropped if its whole
hash equals a prefix hash of a longer one (anti-join on the distinct prefix
hashes); of equal conversations the one with the smallest id stays.  The
maximal ones are rendered.

Running sums are taken within stretches of ``STRETCH`` turns and carried over
the stretches, so a conversation with very many turns is spread over tasks
until its single rendered text is put together.

Defined results
  null conversation id: the row belongs to no conversation and is left out;
  null turn: before all numbered turns; turns of one number: ordered by hash;
  repeated rows: one turn; null role or text: differs from an empty one,
  rendered as empty; numbering may start anywhere, positions count;
  empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prioritext.llm.tables import table, written

STRETCH = 1_024
START, END = "<|im_start|>", "<|im_end|>"


def _hash(seed: int) -> F.Column:
    fields = [c for name in ("role", "text") for c in (F.col(name).isNull(), F.coalesce(name, F.lit("")))]
    return F.xxhash64(F.lit(seed), *fields)


def _before(total: str) -> F.Column:
    w = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(w), F.lit(0))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``(conv_id, place, n, s1, s2)``: each turn's place from 1, the turns in all, the hash up to it."""
    rows = (
        turns.filter(F.col("conv_id").isNotNull())
        .select("conv_id", "turn", _hash(1).alias("h1"), _hash(2).alias("h2"))
        .distinct()
        .withColumn("stretch", F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 62))))
    )
    key = ["conv_id", "stretch"]
    inside = Window.partitionBy(*key).orderBy(F.col("turn").asc_nulls_first(), "h1", "h2")
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("c"))
    counted = counted.select(
        *key, _before("c").alias("skip"), F.sum("c").over(Window.partitionBy("conv_id")).alias("n")
    )
    placed = rows.withColumn("rank", F.row_number().over(inside)).join(counted, key)
    placed = placed.withColumn("place", F.col("skip") + F.col("rank")).select(
        *key,
        "place",
        "n",
        *(F.shiftrightunsigned(F.xxhash64("place", h), 24).alias(h) for h in ("h1", "h2")),
    )
    totals = placed.groupBy(*key).agg(F.sum("h1").alias("t1"), F.sum("h2").alias("t2"))
    totals = totals.select(*key, _before("t1").alias("b1"), _before("t2").alias("b2"))
    running = Window.partitionBy(*key).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumns({"r1": F.sum("h1").over(running), "r2": F.sum("h2").over(running)})
        .join(totals, key)
        .select("conv_id", "place", "n", (F.col("b1") + F.col("r1")).alias("s1"), (F.col("b2") + F.col("r2")).alias("s2"))
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, n_copies)`` of the conversations that no longer one begins with."""
    hashed = written(prefix_hashes(turns), "turn-prefixes")
    # the anti-join key is unique on both sides, however common a first turn or a conversation is
    whole = hashed.filter("place = n").groupBy("n", "s1", "s2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies")
    )
    prefixes = hashed.filter("place < n").select(F.col("place").alias("n"), "s1", "s2").distinct()
    return whole.join(prefixes, ["n", "s1", "s2"], "left_anti").select("conv_id", F.col("n").alias("n_turns"), "n_copies")


def render(turns: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` with the rendered ``text`` of each conversation."""
    part = F.concat(
        F.lit(START), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(f"{END}\n")
    )
    number = F.struct(F.col("turn").isNotNull(), "turn")
    rows = turns.select("conv_id", F.struct(number.alias("turn"), _hash(1).alias("h1"), _hash(2).alias("h2"), part.alias("part")).alias("t"))
    texts = rows.join(chosen, "conv_id").groupBy("conv_id", "n_turns", "n_copies").agg(
        F.sort_array(F.collect_set("t")).alias("ts")
    )
    return texts.select("conv_id", "n_turns", "n_copies", F.array_join("ts.part", "").alias("text"))


def op9_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal conversations of the whole log, rendered."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return render(turns, maximal_conversations(turns))


OP9_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list(struct_pack(r := role, x := text) ORDER BY turn NULLS FIRST) AS l,
         string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), ''
                    ORDER BY turn NULLS FIRST) AS s
  FROM t GROUP BY conv_id
), k AS (SELECT l, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY l)
SELECT k.conv_id, CAST(len(k.l) AS BIGINT) AS n_turns, CAST(k.n_copies AS BIGINT) AS n_copies, c.s AS text
FROM k JOIN c USING (conv_id)
WHERE NOT EXISTS (SELECT 1 FROM c d WHERE len(d.l) > len(k.l) AND d.l[1] = k.l[1] AND d.l[1:len(k.l)] = k.l)
"""
