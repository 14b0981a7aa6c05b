"""MinHash near-duplicates: SuperMinHash signatures, banding, verification, union-find groups.

1. Per text: the distinct word shingles, a fingerprint of the set, and a
   SuperMinHash signature.  Every element draws one permutation of the slots
   and puts ``j + random`` into its j-th slot; the minimum per slot is the
   signature.  Levels j run in step over all elements of a text, which stops
   as soon as every slot holds a value of the current level or less: no later
   draw can be smaller.
2. Equal sets are one class (a partial aggregation, so copies in thousands
   cost one row per task); only class representatives go on.
3. Bands of the signature make buckets.  In a bucket a breadth-first walk
   joins representatives whose signatures agree in enough of the slots; it
   compares with unvisited members only and gives a forest, never all pairs.
   Large buckets are cut into blocks, each pair of blocks being one unit.
4. The forests' components are candidate groups.  Each member's full set is
   made once more and sent to its group, where the same walk confirms links
   by exact intersection and union sizes; large groups are cut likewise.
5. Components of the confirmed links, the smallest id naming each.

Bands and the agreement that step 3 asks for follow the threshold
(:func:`layout`): a pair at the threshold itself misses all bands, and step 3's
test, with a probability of at most 1e-6 each (binomial bounds: 4.3e-7 and
5.1e-7 at 0.85, 8.0e-8 and 6.4e-7 at 0.80); one missed link matters only if no
other path joins the two.

Defined results
  null or empty text: no shingles, linked with nothing;
  null id: cannot be named, so linked with nothing, null component, kept;
  rows of one id: one document; their sets count as linked;
  very long texts and ties: whole sets, smallest id; empty table: empty result;
  extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from math import ceil, comb, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.llm.components import components
from prioritext.llm.tables import parallelism, table, written
from prioritext.llm.words import mix, slices, split_words, window_hashes

SHINGLE = 5
# Slots of a signature; thresholds that need more bands of one row get more.
SLOTS = 125
# Probability with which bands or sift may miss a pair at the threshold.
MISS = 1e-6
# Members of a bucket and shingles of a group that one unit of work holds.
BLOCK_ROWS = 2_048
BLOCK_SHINGLES = 1_500_000

_SHIFT = np.uint64(48)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


class Layout(NamedTuple):
    bands: int
    rows: int
    slots: int
    least: int  # equal slots of a candidate pair


@lru_cache
def layout(percent: int) -> Layout:
    """Bands of as many rows, and as many equal slots, as ``MISS`` allows at a similarity of ``percent``."""
    if not 1 <= percent <= 100:
        raise ValueError(f"similarity of {percent} per cent is outside 1..100")
    p = percent / 100
    fit = [r for r in range(1, SLOTS + 1) if (1 - p**r) ** (SLOTS // r) <= MISS]
    rows = max(fit, default=1)
    bands = SLOTS // rows if fit else ceil(log(MISS) / log(1 - p))
    slots = max(SLOTS, bands * rows)
    least, below = 0, 0.0
    while least < slots:
        below += comb(slots, least) * p**least * (1 - p) ** (slots - least)
        if below > MISS:
            break
        least += 1
    return Layout(bands, rows, slots, least)


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text (sorted), and the bounds of the texts."""
    words = split_words(texts, lower=True)
    hashes = words.hashes()
    grams = window_hashes(hashes, k)
    sets = []
    for low, high in pairwise(words.first.tolist()):
        if high - low >= k:
            sets.append(np.unique(grams[low : high - k + 1]))
        elif high > low:
            whole = window_hashes(hashes[low:high], high - low)
            sets.append(mix(whole + np.uint64(high - low)))
        else:
            sets.append(hashes[:0])
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets], dtype=np.int64)))
    return np.concatenate([hashes[:0], *sets]), bounds


def _draw(elements: np.ndarray, level: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each element at a level: the place it swaps with, and the value it offers."""
    x = mix(elements + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    place = level + ((x >> np.uint64(32)) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
    value = (mix(x) >> np.uint64(16)) + (np.uint64(level) << _SHIFT)
    return place, value


def super_min_hash(elements: np.ndarray, bounds: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (texts x slots) of sets of distinct hashes; rows of empty sets stay at the maximum."""
    n = len(bounds) - 1
    out = np.full(n * slots, _FULL, dtype=np.uint64)
    sizes = np.diff(bounds)
    of = np.repeat(np.arange(n), sizes)
    place, value = _draw(elements, 0, slots)
    np.minimum.at(out, of * slots + place, value)
    out = out.reshape(n, slots)
    open_ = np.flatnonzero((sizes > 0) & (out.max(axis=1) >> _SHIFT > 0))
    # permutations are kept only for texts that need further levels, some at a time
    groups, held, total = [], [], 0
    for t in open_.tolist():
        if held and total + sizes[t] > 20_000:
            groups.append(held)
            held, total = [], 0
        held.append(t)
        total += sizes[t]
    for group in [*groups, held] if held else groups:
        mine = np.concatenate([elements[bounds[t] : bounds[t + 1]] for t in group])
        row = np.repeat(np.arange(len(group)), sizes[group])
        first = np.concatenate([place[bounds[t] : bounds[t + 1]] for t in group])
        best = out[group].copy()
        order = np.tile(np.arange(slots, dtype=np.int16), (len(mine), 1))
        at = np.arange(len(mine))
        order[at, first] = 0
        alive = np.ones(len(group), dtype=bool)
        for level in range(1, slots):
            swap, offer = _draw(mine, level, slots)
            slot = order[at, swap].astype(np.int64)
            order[at, swap] = order[:, level]
            flat = best.reshape(-1)
            np.minimum.at(flat, row * slots + slot, offer)
            alive &= best.max(axis=1) >> _SHIFT > np.uint64(level)
            if not alive.any():
                break
            stay = alive[row]
            if stay.sum() * 2 < len(stay):
                mine, row, order = mine[stay], row[stay], order[stay]
                at = np.arange(len(mine))
        out[group] = best
    return out


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(values)))
    return (total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)


def _fingerprints(elements: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _sums(mix(elements), bounds), _sums(mix(elements ^ np.uint64(0xE7037ED1A0B428DB)), bounds)


def signatures(docs: DataFrame, percent: int) -> DataFrame:
    """``(doc_id, n_shingles, fp1, fp2, sig, bands)`` of every row of ``docs(doc_id, text)``."""
    n_bands, n_rows, slots, _ = layout(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                elements, bounds = shingle_sets(part.column("text"))
                full = super_min_hash(elements, bounds, slots)
                fp1, fp2 = _fingerprints(elements, bounds)
                wide = full[:, : n_bands * n_rows].reshape(len(full), n_bands, n_rows)
                bands = np.arange(n_bands, dtype=np.uint64)[None, :].repeat(len(full), 0)
                for r in range(n_rows):
                    bands = mix(bands + wide[:, :, r])
                small = mix(full.ravel()).astype(np.uint8).reshape(full.shape)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(bounds)),
                        pa.array(fp1),
                        pa.array(fp2),
                        pa.array([s.tobytes() for s in small], type=pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, bands.size + 1, n_bands, dtype=np.int32)),
                            pa.array(bands.view(np.int64).ravel()),
                        ),
                    ],
                    names=["doc_id", "n_shingles", "fp1", "fp2", "sig", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, fp1 long, fp2 long, sig binary, bands array<long>"
    )


def _in_blocks(members: DataFrame, key: str, blocks: str) -> DataFrame:
    """Units ``(key, i, j)``: all pairs of the ``blocks`` blocks that a key's members are dealt to."""
    dealt = members.withColumn("block", F.pmod(F.xxhash64("node", F.lit(17)), F.col(blocks)))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    return dealt.withColumn("other", other).withColumns(
        {"i": F.least("block", "other"), "j": F.greatest("block", "other")}
    ).drop("block", "other", blocks)


def _units(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """One table per run of equal ``(key, i, j)`` with two rows or more."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in (key, "i", "j")]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        begin = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for low, high in pairwise(begin):
            unit = tuple(c[low] for c in cols)
            if unit != last and held:
                if sum(map(len, held)) > 1:
                    yield pa.Table.from_batches(held)
                held = []
            last = unit
            if high - low > 1 or high == batch.num_rows or held:
                held.append(batch.slice(low, high - low))
    if sum(map(len, held)) > 1:
        yield pa.Table.from_batches(held)


def _forest(n: int, near) -> tuple[list[int], list[int]]:
    """Breadth-first forest over 0..n-1; ``near(a, rest)`` flags the unvisited that a touches."""
    rest, left, right = np.arange(n), [], []
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            a = queue.pop()
            hit = near(a, rest)
            found = rest[hit]
            if len(found):
                left += [a] * len(found)
                right += found.tolist()
                queue += found.tolist()
                rest = rest[~hit]
    return left, right


def _edges(nodes: np.ndarray, left: list[int], right: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array(nodes[left]), "b": pa.array(nodes[right])})


def _candidate_links(classes: DataFrame, percent: int) -> DataFrame:
    """Forests, per bucket, of representatives whose signatures agree in enough slots for ``percent``."""
    n = parallelism(classes.sparkSession)
    rows = classes.select(F.col("rep").alias("node"), F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = rows.join(shared, "bucket").withColumn("blocks", F.ceil(F.col("size") / BLOCK_ROWS)).drop("size")
    members = members.join(classes.select(F.col("rep").alias("node"), "sig"), "node")
    _, _, slots, least = layout(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _units(batches, "bucket"):
            sig = np.frombuffer(b"".join(unit.column("sig").to_pylist()), dtype=np.uint8).reshape(-1, slots)
            left, right = _forest(len(sig), lambda a, rest: (sig[rest] == sig[a]).sum(axis=1) >= least)
            if left:
                yield _edges(unit.column("node").to_numpy(), left, right)

    units = _in_blocks(members, "bucket", "blocks")
    return units.repartition(n, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(
        run, "a long, b long"
    ).distinct()


def _confirmed_links(docs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links of each candidate group that hold on full sets, as forests per unit.

    ``groups``: ``(node, component, fp1, fp2, n_shingles)``.
    """
    n = parallelism(docs.sparkSession)
    weight = groups.groupBy("component").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks"))
    members = groups.join(weight, "component").select("node", "component", "blocks", "fp1", "fp2")
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(members, "node")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                elements, bounds = shingle_sets(part.column("text"))
                fp1, fp2 = _fingerprints(elements, bounds)
                # rows of one id may hold other texts than the representative's
                own = (fp1 == part.column("fp1").to_numpy()) & (fp2 == part.column("fp2").to_numpy())
                sets = [elements[a:b].tobytes() for a, b in pairwise(bounds.tolist())]
                out = pa.RecordBatch.from_pydict(
                    {c: part.column(c) for c in ("node", "component", "blocks")} | {"elements": pa.array(sets, pa.binary())}
                )
                yield out.filter(pa.array(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _units(batches, "component"):
            sets = [np.frombuffer(s, dtype=np.uint64) for s in unit.column("elements").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            number = np.unique(np.concatenate(sets), return_inverse=True)[1]
            mark = np.zeros(int(number.max()) + 1, dtype=bool)

            def near(a: int, rest: np.ndarray) -> np.ndarray:
                hit = np.zeros(len(rest), dtype=bool)
                small, big = np.minimum(sizes[rest], sizes[a]), np.maximum(sizes[rest], sizes[a])
                fit = np.flatnonzero(100 * small >= percent * big)
                mine = number[bounds[a] : bounds[a + 1]]
                mark[mine] = True
                # some members at a time, so that no array outgrows a unit's own size
                for some in np.array_split(fit, max(1, int(sizes[rest[fit]].sum()) // 2_000_000 + 1)):
                    if len(some):
                        b = rest[some]
                        size = sizes[b]
                        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
                        where = np.arange(int(size.sum())) + np.repeat(bounds[b] - begin, size)
                        both = np.add.reduceat(mark[number[where]].astype(np.int64), begin)
                        hit[some] = 100 * both >= percent * (size + sizes[a] - both)
                mark[mine] = False
                return hit

            left, right = _forest(len(sets), near)
            if left:
                yield _edges(unit.column("node").to_numpy(), left, right)

    sets = texts.mapInArrow(to_sets, "node long, component long, blocks long, elements binary")
    units = _in_blocks(sets, "component", "blocks")
    return units.repartition(n, "component", "i", "j").sortWithinPartitions("component", "i", "j").mapInArrow(
        run, "a long, b long"
    )


def near_duplicate_groups(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``.

    Documents are linked if ``100 * |A & B| >= percent * |A | B|`` on their
    shingle sets; ``component_id`` is the smallest id reachable over links.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = written(signatures(docs, percent), "signatures")
    linked = signed.filter("n_shingles > 0 and doc_id is not null")
    first = F.min(F.struct("doc_id", "n_shingles", "sig", "bands")).alias("first")
    classes = written(
        linked.groupBy("fp1", "fp2").agg(first).select(
            "fp1", "fp2", F.col("first.doc_id").alias("rep"), "first.n_shingles", "first.sig", "first.bands"
        ),
        "classes",
    )
    candidates = components(_candidate_links(classes, percent), "candidates")
    groups = candidates.join(
        classes.select(F.col("rep").alias("node"), "fp1", "fp2", "n_shingles"), "node"
    )
    confirmed = components(_confirmed_links(docs, groups, percent), "confirmed")
    # rows of one id with different sets are one document: each of their classes is linked to the smallest
    of_set = F.struct("fp1", "fp2")
    several = linked.groupBy("doc_id").agg(F.min(of_set).alias("low"), F.max(of_set).alias("high")).filter("low <> high")
    if several.isEmpty():
        final = confirmed
    else:
        owned = linked.join(several.select("doc_id"), "doc_id", "left_semi").select("doc_id", "fp1", "fp2").distinct()
        owned = written(owned.join(classes.select("fp1", "fp2", "rep"), ["fp1", "fp2"]).select("doc_id", "rep"), "owned")
        least = owned.groupBy("doc_id").agg(F.min("rep").alias("b"))
        doubled = owned.join(least, "doc_id").filter("rep <> b").select(F.col("rep").alias("a"), "b")
        final = components(confirmed.select(F.col("node").alias("a"), F.col("component").alias("b")).union(doubled), "ids")
    named = classes.select("fp1", "fp2", F.col("rep").alias("node")).join(final, "node", "left").select(
        "fp1", "fp2", F.coalesce("component", "node").alias("root")
    )
    usable = F.col("n_shingles").isNotNull() & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return signed.select("doc_id", "n_shingles", "fp1", "fp2").join(named, ["fp1", "fp2"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(usable, F.col("root")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op6_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at a Jaccard similarity of 0.85."""
    return near_duplicate_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM d
), n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * k >= 85 * (na.n_shingles + nb.n_shingles - k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c USING (doc_id)
"""
