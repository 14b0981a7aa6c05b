"""Removal of word passages that occur more than once, by De Bruijn compaction.

The edges of the graph are the windows of ``k`` consecutive words; two windows
that follow each other share a node of ``k - 1`` words.  An edge is repeated if
its words start at two places or more.

1. Every text is cut into paths of consecutive windows with the same
   minimiser (the smallest hash of the ``gram``-word sequences inside the
   window).  Equal windows have equal minimisers, so paths that share an edge
   meet under one key, and a nonbranching path travels as one row: its source
   coordinate and the hashes of its windows.
2. Within a slice of texts each edge is sent once; places that repeat inside
   the slice are known at once and sent as spans.  A passage that a third of
   all texts share thus sends one row per slice, not one per text.
3. A minimiser that very many texts hold in different surroundings (found on
   a sample, which steers the layout only) gets its windows sent one by one
   under their own hash.
4. Under each key repeated edges are marked, in parts of bounded size, and
   neighbouring ones compacted to spans; a join by source coordinate brings the spans of a text together,
   where spans that touch or overlap merge.

Windows are compared by two hashes, each made from the words by a polynomial
and a finaliser of its own: a 64-bit one (or the minimiser's, which equal
windows share) and the second one, 64 bits inside a slice and 48 between
slices.  A word leaves only where both agree; the words themselves aren't
compared again.

Defined results
  null or empty text, or fewer than k words: nothing is removed;
  null id: an id of its own kind, compared null-safe;
  repeated rows: each row is a document; their windows repeat each other;
  very long text: worked on whole; ties: windows are judged on the input;
  empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.llm.tables import parallelism, table
from prioritext.llm.words import SECOND_ROLL, cover, mix, slices, sliding_min, split_words, window_hashes

WINDOW = 35
GRAM = 8
# Texts looked at to find frequent minimisers (one in ``SAMPLE_EVERY`` where
# that is more), and the share of ``SAMPLE_ROWS`` that makes one frequent: a
# minimiser below it is held by some 200,000 texts, however many there are.
# Any choice gives the same result.
SAMPLE_ROWS = 20_000
SAMPLE_EVERY = 5_000
FREQUENT = 0.002
# Texts of this size are worked on together: the reach of step 2.
REACH_BYTES = 4_000_000
HASH_BYTES = 6
_OTHER = np.uint64(0xA0761D6478BD642F)

_KEYS = "doc_id long, crc long, "


def _coordinates(part: pa.RecordBatch) -> tuple[list, np.ndarray]:
    texts = part.column("text")
    crc = [zlib.crc32(t.as_buffer()) if t.is_valid else 0 for t in texts]
    return part.column("doc_id").to_pylist(), np.array(crc, dtype=np.int64)


def _keyed_windows(texts: pa.Array, k: int, gram: int):
    """Of all windows: text, place in it, hash, second hash, minimiser."""
    words = split_words(texts)
    hashes = words.hashes()
    if len(hashes) < k:
        none = np.zeros(0, dtype=np.int64)
        return none, none, *[none.astype(np.uint64)] * 3
    valid = words.windows(k)[: len(hashes) - k + 1]
    low = sliding_min(window_hashes(hashes, gram), k - gram + 1)[valid]
    text = words.text_of_word()[: len(valid)][valid]
    place = np.flatnonzero(valid) - words.first[text]
    second = window_hashes(mix(hashes ^ _OTHER), k, SECOND_ROLL)
    return text, place, window_hashes(hashes, k)[valid], second[valid], low


def frequent_minimisers(docs: DataFrame, k: int, gram: int) -> np.ndarray:
    """Minimisers that at least ``FREQUENT`` of the sampled texts hold (sorted).

    They are few: each takes 40 texts of the sample, beyond 100 million texts
    at least 200,000 of all.
    """
    n = docs.count()
    share = max(1, min(n // SAMPLE_ROWS, SAMPLE_EVERY))
    sample = docs.filter(F.pmod(F.xxhash64("text", "doc_id"), F.lit(share)) == 0).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, _, _, _, low = _keyed_windows(part.column("text"), k, gram)
                if len(low):
                    # one per text
                    order = np.lexsort((low, text))
                    t, m = text[order], low[order]
                    m = m[np.concatenate(([True], (t[1:] != t[:-1]) | (m[1:] != m[:-1])))]
                    found, texts = np.unique(m, return_counts=True)
                    yield pa.RecordBatch.from_pydict({"m": found.view(np.int64), "texts": texts})

    counted = sample.mapInArrow(run, "m long, texts long").groupBy("m").agg(F.sum("texts").alias("texts"))
    least = max(16, int(FREQUENT * min(n, SAMPLE_ROWS)))
    rows = counted.filter(F.col("texts") >= least).select("m").toPandas()["m"]
    return np.sort(rows.to_numpy(dtype=np.int64).view(np.uint64))


def _tail_bytes(hashes: np.ndarray) -> np.ndarray:
    """``HASH_BYTES`` bytes of each second hash."""
    return hashes.view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]


def _paths(part: pa.RecordBatch, k: int, gram: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows ``(key, doc_id, crc, start, n, hashes)``; without hashes: a span already known to repeat."""
    text, place, hashes, second, low = _keyed_windows(part.column("text"), k, gram)
    if not len(hashes):
        return
    ids, crc = _coordinates(part)
    order = np.argsort(hashes, kind="stable")
    sorted_, other = hashes[order], second[order]
    again = np.concatenate(([False], sorted_[1:] == sorted_[:-1]))
    if (again[1:] & (other[1:] != other[:-1])).any():  # unequal windows under one hash: order by both
        order = np.lexsort((second, hashes))
        sorted_, other = hashes[order], second[order]
        again = np.concatenate(([False], (sorted_[1:] == sorted_[:-1]) & (other[1:] == other[:-1])))
    repeated = np.zeros(len(hashes), dtype=bool)
    repeated[order[again]] = True  # not the first of its kind
    later = repeated.copy()
    repeated[order[np.append(again[1:], False)]] = True
    follows = np.concatenate(([False], (text[1:] == text[:-1]) & (place[1:] == place[:-1] + 1)))

    def runs(flags: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = flags & ~(np.concatenate(([False], flags[:-1])) & ~breaks)
        end = flags & ~np.append(flags[1:] & ~breaks[1:], False)
        return np.flatnonzero(begin), np.flatnonzero(end) + 1

    begin, end = runs(repeated, ~follows)
    known = len(begin)
    alone = np.isin(low, frequent) if len(frequent) else np.zeros(len(low), dtype=bool)
    changed = np.concatenate(([True], low[1:] != low[:-1])) | alone
    first, last = runs(~later, ~follows | changed)
    tail = _tail_bytes(second).tobytes()
    key = np.where(alone, hashes, low)[first]
    blobs = [None] * known + [tail[a * HASH_BYTES : b * HASH_BYTES] for a, b in zip(first, last, strict=True)]
    begin, end = np.concatenate((begin, first)), np.concatenate((end, last))
    of = text[begin]
    keys = np.concatenate((mix(crc[of[:known]].view(np.uint64)), key))
    yield pa.RecordBatch.from_pydict(
        {
            "key": pa.array(keys.view(np.int64)),
            "doc_id": pa.array([ids[i] for i in of], type=pa.int64()),
            "crc": pa.array(crc[of]),
            "start": pa.array(place[begin].astype(np.int32)),
            "n": pa.array((end - begin).astype(np.int32)),
            "hashes": pa.array(blobs, type=pa.binary()),
        }
    )


def _repeated_runs(rows: pa.Table) -> pa.RecordBatch:
    """Spans of consecutive windows that occur twice or more under their key."""
    blobs = rows.column("hashes").combine_chunks()
    blobs = blobs.chunk(0) if isinstance(blobs, pa.ChunkedArray) else blobs
    n = rows.column("n").to_numpy().astype(np.int64)
    known = np.asarray(blobs.is_null())
    sent = ~known
    raw = np.frombuffer(b"".join(blobs.drop_null().to_pylist()), dtype=np.uint8).reshape(-1, HASH_BYTES)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, :HASH_BYTES] = raw
    value = wide.view(np.uint64).ravel()
    key = np.repeat(rows.column("key").to_numpy()[sent].view(np.uint64), n[sent])
    order = np.lexsort((value, key))
    k, v = key[order], value[order]
    same = (k[1:] == k[:-1]) & (v[1:] == v[:-1])
    twice = np.zeros(len(v), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    row = np.repeat(np.flatnonzero(sent), n[sent])
    within = np.arange(len(v)) - np.repeat(np.concatenate(([0], np.cumsum(n[sent])[:-1])), n[sent])
    border = np.concatenate(([True], row[1:] != row[:-1])) if len(row) else np.zeros(0, dtype=bool)
    begin = np.flatnonzero(twice & (border | ~np.concatenate(([False], twice[:-1])))) if len(row) else np.zeros(0, int)
    end = np.flatnonzero(twice & np.append(border[1:] | ~twice[1:], True)) + 1 if len(row) else np.zeros(0, int)
    at = np.concatenate((np.flatnonzero(known), row[begin]))
    start = rows.column("start").to_numpy()
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": rows.column("doc_id").combine_chunks().take(pa.array(at)),
            "crc": rows.column("crc").combine_chunks().take(pa.array(at)),
            "start": pa.array(np.concatenate((start[known], start[row[begin]] + within[begin])).astype(np.int32)),
            "n": pa.array(np.concatenate((n[known], end - begin)).astype(np.int32)),
        }
    )


def _one_each(rows: pa.Table) -> pa.Table:
    """The first place of every window under one key, a row each."""
    sent = rows.filter(rows.column("hashes").is_valid())
    raw = np.frombuffer(b"".join(sent.column("hashes").to_pylist()), dtype="V%d" % HASH_BYTES)
    n = sent.column("n").to_numpy()
    row = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, :HASH_BYTES] = raw.view(np.uint8).reshape(-1, HASH_BYTES)
    first = np.unique(wide.view(np.uint64).ravel(), return_index=True)[1]
    at = row[first]
    return pa.table(
        {
            "key": sent.column("key").take(at),
            "doc_id": sent.column("doc_id").take(at),
            "crc": sent.column("crc").take(at),
            "start": pa.array((sent.column("start").to_numpy()[at] + within[first]).astype(np.int32)),
            "n": pa.array(np.ones(len(at), dtype=np.int32)),
            "hashes": pa.array([h.tobytes() for h in raw[first]], type=pa.binary()),
        },
        schema=rows.schema,
    )


def _by_key(batches: Iterator[pa.RecordBatch], at_least: int = 100_000) -> Iterator[pa.Table]:
    """Sorted batches joined to tables that do not cut through a key.

    A key that fills a table by itself is given out in parts, each beginning
    with one row per window seen under the key before, so that a repeat meets
    its partner and memory follows the distinct windows, not the rows.
    """
    held: list[pa.RecordBatch] = []
    rows, limit = 0, at_least
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < limit:
            continue
        joined = pa.Table.from_batches(held)
        keys = joined.column("key").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield joined.slice(0, cut)
            rest = joined.slice(cut)
        else:
            yield joined
            rest = _one_each(joined)
        held, rows = rest.combine_chunks().to_batches(), rest.num_rows
        limit = max(at_least, 2 * rows)
    if held:
        yield pa.Table.from_batches(held)


def repeated_spans(docs: DataFrame, k: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(doc_id, crc, start, n)``: ``n`` consecutive windows from word ``start`` that occur elsewhere too.

    ``docs`` has ``doc_id`` and ``text``; ``crc`` (CRC-32 of the text) tells rows of one id apart.
    Spans of one text may touch or overlap.
    """
    frequent = frequent_minimisers(docs, k, gram)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", REACH_BYTES):
                yield from _paths(part, k, gram, frequent)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches):
            yield _repeated_runs(rows)

    paths = docs.select("doc_id", "text").mapInArrow(
        cut, "key long, doc_id long, crc long, start int, n int, hashes binary"
    )
    return (
        paths.repartition(parallelism(docs.sparkSession), "key")
        .sortWithinPartitions("key")
        .mapInArrow(mark, _KEYS + "start int, n int")
    )


def _with_spans(docs: DataFrame, k: int, gram: int) -> DataFrame:
    """``docs`` with ``starts`` and ``lengths`` of the repeated spans of each row, null where there are none."""
    spans = repeated_spans(docs, k, gram).groupBy("doc_id", "crc").agg(
        # a set: rows equal in id and text send the same spans; bounded by the length of one text
        F.collect_set(F.struct("start", "n")).alias("spans")
    )
    spans = spans.select(F.col("doc_id").alias("_span_id"), F.col("crc").alias("_span_crc"), "spans")
    crc = F.crc32(F.coalesce(docs["text"], F.lit("")))
    found = docs["doc_id"].eqNullSafe(spans["_span_id"]) & (crc == spans["_span_crc"])
    return docs.join(spans, found, "left").select(
        *(docs[c] for c in docs.columns), spans["spans.start"].alias("_starts"), spans["spans.n"].alias("_lengths")
    )


def _kept_words(part: pa.RecordBatch, k: int) -> Iterator[tuple[pa.LargeStringScalar | pa.StringScalar, int, list[bytes]]]:
    """Of each row: its text, its number of words, the words that stay."""
    rows = zip(part.column("text"), part.column("_starts").to_pylist(), part.column("_lengths").to_pylist(), strict=True)
    for text, starts, lengths in rows:
        words = text.as_buffer().to_pybytes().split() if text.is_valid else []
        if starts is None:
            yield text, len(words), words
            continue
        stays = np.ones(len(words), dtype=bool)
        for s, n in zip(starts, lengths, strict=True):
            stays[s : s + n + k - 1] = False
        yield text, len(words), list(compress(words, stays.tolist()))


def removals(docs: DataFrame, k: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of every row of ``docs(doc_id, text)``.

    The digest is of the kept words joined by one space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = [(n, n - len(w), hashlib.sha256(b" ".join(w)).hexdigest()) for _, n, w in _kept_words(part, k)]
                cols = [part.column("doc_id"), *(pa.array(c) for c in zip(*out, strict=True))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    spans = _with_spans(docs.select("doc_id", "text"), k, gram)
    return spans.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, k: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` (all columns) with the repeated passages taken out of ``text``.

    A text that loses words becomes its kept words joined by one space; others stay as they are.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t.as_py() if n == len(w) else b" ".join(w).decode() for t, n, w in _kept_words(part, k)]
                cols = {c: part.column(c) for c in names}
                yield pa.RecordBatch.from_pydict(cols | {"text": pa.array(texts, part.column("text").type)})

    return _with_spans(docs, k, gram).mapInArrow(run, docs.schema)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that repeated 35-word passages take from it."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return removals(docs)


OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), g AS (
  SELECT rid, i, array_to_string(ws[i:i + 34], ' ') AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM d)
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY gram) AS n FROM g) WHERE n > 1
), gone AS (
  SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM rep
), words AS (
  SELECT rid, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d
), kept AS (
  SELECT rid, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
