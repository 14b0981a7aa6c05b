"""Exact top-k inner products by a three-phase uniform threshold.

A vector's components are cut into ``LISTS`` runs; each run ranks the
candidates by its own share of the inner product, and the score of a
candidate is the sum of its shares.

1. Every task gathers, per query and run, the local list of the k best
   candidates by share, and sends the k best full scores among the listed.
   The k-th best of all tasks is a cutoff that the true k-th score can't be
   below.
2. A candidate at or above the cutoff has a share of at least
   ``cutoff / LISTS`` in some run.  With the cutoffs broadcast (one number
   per query of a block of bounded size), tasks collect the candidates that
   reach it and whose upper bound (unlisted shares at that threshold) can
   still make the cutoff.
3. Their full scores are resolved exactly; each task sends its k best, and a
   rank over them is the result.

Queries go in blocks of at most about ``QUERY_BLOCK``, each against all rows.
Scores are integers: components are ``floor(64 * x)``.  They are summed in
doubles, exact for sums below 2**53.

Defined results
  null id, null vector, or a null or non-finite component: takes no part;
  vectors of different lengths: missing components count as zero;
  ties: the smaller id; repeated rows: each is a candidate, a query once;
  rows with a query's own id are not its candidates; fewer than k: all;
  empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prioritext.llm.tables import table

LISTS = 4
QUERY_BLOCK = 4_096
SUB_BATCH = 512
_LOW = -np.inf


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id, vec)`` of the rows that take part, components as ``floor(64 * x)`` in doubles."""
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad
    return vectors.filter(usable).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vec_col, lambda x: F.floor(x.cast("double") * 64).cast("double")).alias("vec"),
    )


def _matrix(vecs: pa.Array, dim: int) -> np.ndarray:
    sizes = vecs.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vecs.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    begin = np.concatenate(([0], np.cumsum(sizes)))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(begin[:-1], sizes)] = flat
    return out


class Block:
    """A block of queries: ids ascending, components cut into runs."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray):
        self.ids, self.vecs = ids, vecs
        self.cuts = np.linspace(0, vecs.shape[1], LISTS + 1).astype(int)

    def shares(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Candidate ids, and their shares (run x query x candidate); a query's own rows are at minus infinity."""
        for batch in batches:
            all_ids = batch.column("id").to_numpy()
            vecs = _matrix(batch.column("vec"), self.vecs.shape[1])
            for low in range(0, len(all_ids), SUB_BATCH):
                ids, x = all_ids[low : low + SUB_BATCH], vecs[low : low + SUB_BATCH]
                cut = self.cuts
                share = np.stack([self.vecs[:, a:b] @ x[:, a:b].T for a, b in zip(cut[:-1], cut[1:], strict=True)])
                first, last = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
                for j in np.flatnonzero(last > first):
                    share[:, first[j] : last[j], j] = _LOW
                yield ids, share


def _cutoffs(candidates: DataFrame, block, k: int) -> np.ndarray:
    """Phase 1: per query of the block a score that at least k candidates reach (minus infinity if fewer exist)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = block.value
        n = len(queries.ids)
        best = np.full((LISTS, n, k), _LOW)  # shares in the local lists
        total = np.full((LISTS, n, k), _LOW)  # full scores of the listed
        place = np.full((LISTS, n, k), -1, dtype=np.int64)  # which candidate of the task
        seen = 0
        for ids, share in queries.shares(batches):
            score = share.sum(axis=0)
            here = np.arange(seen, seen + len(ids))
            for r in range(LISTS):
                rows = np.flatnonzero((share[r] > best[r].min(axis=1)[:, None]).any(axis=1))
                if len(rows):
                    both = np.concatenate((best[r, rows], share[r][rows]), axis=1)
                    top = np.argpartition(both, both.shape[1] - k, axis=1)[:, -k:]
                    best[r, rows] = np.take_along_axis(both, top, 1)
                    both = np.concatenate((total[r, rows], score[rows]), axis=1)
                    total[r, rows] = np.take_along_axis(both, top, 1)
                    both = np.concatenate((place[r, rows], np.broadcast_to(here, (len(rows), len(here)))), axis=1)
                    place[r, rows] = np.take_along_axis(both, top, 1)
            seen += len(ids)
        if not seen:
            return
        # a candidate listed by several runs counts once
        flat_place, flat_total = place.transpose(1, 0, 2).reshape(n, -1), total.transpose(1, 0, 2).reshape(n, -1)
        order = np.argsort(flat_place, axis=1, kind="stable")
        flat_place, flat_total = np.take_along_axis(flat_place, order, 1), np.take_along_axis(flat_total, order, 1)
        flat_total[:, 1:][flat_place[:, 1:] == flat_place[:, :-1]] = _LOW
        top = np.sort(flat_total, axis=1)[:, -k:]
        lists = pa.ListArray.from_arrays(np.arange(0, n * k + 1, k, dtype=np.int32), pa.array(top.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), lists], names=["q", "top"])

    merged = (
        candidates.mapInArrow(gather, "q long, top array<double>")
        .groupBy("q")
        .agg(F.sort_array(F.flatten(F.collect_list("top")), asc=False).alias("top"))
        .select("q", F.try_element_at("top", F.lit(k)).alias("cutoff"))
    )
    out = np.full(len(block.value.ids), _LOW)
    for row in merged.toLocalIterator():  # one number per query of the block
        out[row["q"]] = _LOW if row["cutoff"] is None else row["cutoff"]
    return out


def _resolved(candidates: DataFrame, block, cutoffs, k: int) -> DataFrame:
    """Phases 2 and 3: ``(query_id, id, score)``, the k best of each task at or above the cutoffs."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, cutoff = block.value, cutoffs.value
        least = (cutoff / LISTS)[:, None]
        held: list[np.ndarray] = []
        size = 0
        for ids, share in queries.shares(batches):
            bound = np.maximum(share, least[None]).sum(axis=0)
            q, j = np.nonzero((share >= least[None]).any(axis=0) & (bound >= cutoff[:, None]) & (share[0] > _LOW))
            score = share[:, q, j].sum(axis=0)
            keep = score >= cutoff[q]
            held.append(np.stack((q[keep], ids[j[keep]], score[keep].astype(np.int64))))
            size += held[-1].shape[1]
            if size > 50 * k * len(queries.ids):
                held = [_best(np.concatenate(held, axis=1), k)]
                size = held[0].shape[1]
        if size:
            q, found, score = _best(np.concatenate(held, axis=1), k)
            yield pa.RecordBatch.from_pydict({"query_id": queries.ids[q], "id": found, "score": score})

    return candidates.mapInArrow(collect, "query_id long, id long, score long")


def _best(found: np.ndarray, k: int) -> np.ndarray:
    found = found[:, np.lexsort((found[1], -found[2], found[0]))]
    begin = np.searchsorted(found[0], found[0])
    return found[:, np.arange(found.shape[1]) - begin < k]


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of ``vectors(id, vec)`` for each of ``queries(id, vec)``."""
    spark = vectors.sparkSession
    queries = queries.distinct()
    dim = vectors.agg(F.max(F.size("vec"))).first()[0]
    n_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    parts = []
    for number in range(n_blocks):
        some = queries.filter(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == number).toArrow().sort_by("id")
        if not some.num_rows:
            continue
        vecs = _matrix(some.column("vec").combine_chunks(), dim)
        block = spark.sparkContext.broadcast(Block(some.column("id").to_numpy(), vecs))
        cutoffs = spark.sparkContext.broadcast(_cutoffs(vectors, block, k))
        parts.append(_resolved(vectors, block, cutoffs, k))
    if not parts:
        none = vectors.limit(0)
        return none.select("id", F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score")).withColumnRenamed("id", "query_id")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )


def op3_uniform_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all vectors for every vector whose id is divisible by 20."""
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("id") % 20 == 0), 20)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS z FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, least(len(q.z), len(c.z)) + 1), lambda i: q.z[i] * c.z[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
