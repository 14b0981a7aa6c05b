"""Quality rules as a short-circuit cascade ordered by rejection per cost.

Each rule needs one feature of the text and rejects on it.  On a sample of
the documents every rule is timed and its rejections counted; rules then run
in descending order of rejections per second, each one only on the texts that
all earlier rules let pass.  The verdict is the conjunction of the rules, so
the order (which depends on timing) never changes it.

Defined results
  null or empty text: no words, rejected by ``too_few_words``;
  null id: the row is kept as it is, with a null id;
  repeated rows: each is judged by itself;
  very long text: read whole; tasks work in slices of bounded size;
  empty table: empty result, rules in their given order;
  extra columns (also named like a result column): not read, not returned.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.llm.tables import table
from prioritext.llm.words import Words, cover, mix, slices, split_words, window_hashes

# Rows (one per 1/SAMPLE_ROWS of the hash space) that cost and selectivity are
# estimated on; only the order of the rules depends on them.
SAMPLE_ROWS = 2_000

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NEWLINE = np.uint8(10)


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


class Features:
    """Features of a slice of texts, each computed when first asked for."""

    def __init__(self, texts: pa.Array):
        self._texts = texts
        self.words: Words = split_words(texts)
        self._known: dict[str, np.ndarray] = {}

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self._known:
            getattr(self, f"_add_{name}")()
        return self._known[name]

    def _add_n_words(self) -> None:
        self._known["n_words"] = self.words.counts.astype(np.int64)

    def _add_word_chars(self) -> None:
        data = self.words.data
        lead = (data & 0xC0) != 0x80
        lead &= (data != 0x20) & ((data < 0x09) | (data > 0x0D))
        self._known["word_chars"] = _per_text(lead, self.words.offsets)

    def _add_n_symbols(self) -> None:
        self._known["n_symbols"] = _per_text(_SYMBOL[self.words.data], self.words.offsets)

    def _add_n_lines(self) -> None:
        """Lines with a word, and those equal to an earlier line of their text."""
        w = self.words
        n = len(w.counts)
        lines, repeated = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        breaks = np.flatnonzero(w.data == _NEWLINE)
        begin = np.union1d(w.offsets[:-1], breaks + 1)
        begin = begin[begin < len(w.data)]
        if len(begin):
            end = np.append(begin[1:], len(w.data))
            worded = np.searchsorted(w.starts, end) > np.searchsorted(w.starts, begin)
            of = np.searchsorted(w.offsets, begin, side="right") - 1
            raw = w.data.tobytes()
            lines = np.bincount(of[worded], minlength=n)
            for text in np.flatnonzero(lines > 1):
                mine = np.flatnonzero(worded & (of == text)) if n == 1 else self._lines_of(text, of, worded)
                seen = {raw[begin[i] : end[i]].removesuffix(b"\n") for i in mine}
                repeated[text] = len(mine) - len(seen)
        self._known["n_lines"], self._known["n_dup_lines"] = lines.astype(np.int64), repeated

    @staticmethod
    def _lines_of(text: int, of: np.ndarray, worded: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(of, [text, text + 1])
        return low + np.flatnonzero(worded[low:high])

    _add_n_dup_lines = _add_n_lines

    def _add_n_repeat_words(self) -> None:
        """Words inside 3-word windows that occur twice or more in their text."""
        w = self.words
        hashes = window_hashes(w.hashes(), 3)
        if not len(hashes):
            self._known["n_repeat_words"] = np.zeros(len(w.counts), dtype=np.int64)
            return
        valid = w.windows(3)[: len(hashes)]
        of = w.text_of_word()[: len(hashes)].astype(np.uint64)
        key = mix(hashes + mix(of))[valid]
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        flags = np.zeros(len(hashes), dtype=bool)
        flags[valid] = twice
        self._known["n_repeat_words"] = _per_text(cover(flags, 3), w.first)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Features], np.ndarray]


# Production rules; integer arithmetic, so that SQL gives the same verdicts.
RULES: tuple[Rule, ...] = (
    Rule("too_few_words", lambda f: f["n_words"] < 50),
    Rule("many_symbols", lambda f: 10 * f["n_symbols"] > f["n_words"]),
    Rule(
        "odd_word_length",
        lambda f: (f["word_chars"] < 2 * f["n_words"]) | (f["word_chars"] > 12 * f["n_words"]),
    ),
    Rule("repeated_lines", lambda f: 100 * f["n_dup_lines"] > 30 * f["n_lines"]),
    Rule("repeated_words", lambda f: 100 * f["n_repeat_words"] > 50 * f["n_words"]),
)
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def cascade(texts: pa.Array, rules: Sequence[Rule]) -> np.ndarray:
    """True for the texts that no rule rejects; a rule sees the survivors of those before it."""
    kept = np.ones(len(texts), dtype=bool)
    alive, features = np.arange(len(texts)), None
    for rule in rules:
        if not len(alive):
            break
        if features is None or len(alive) * 2 < len(features.words.counts):
            # enough texts are gone to make the split of the rest worth it
            features, base = Features(texts.take(pa.array(alive))), alive
        bad = rule.rejects(features)
        kept[base[bad]] = False
        alive = alive[kept[alive]]
    return kept


def rule_stats(docs: DataFrame, rules: Sequence[Rule], text_col: str = "text") -> DataFrame:
    """``(rule, seconds, rejected, sampled)`` of each rule alone, on a hash sample of the documents."""
    n = docs.count()
    share = max(1, n // SAMPLE_ROWS)
    sample = docs.filter(F.pmod(F.xxhash64(F.col(text_col)), F.lit(share)) == 0).select(text_col)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                for i, rule in enumerate(rules):
                    began = time.perf_counter()
                    rejected = int(rule.rejects(Features(part.column(text_col))).sum())
                    yield pa.RecordBatch.from_pydict(
                        {"i": [i], "seconds": [time.perf_counter() - began], "rejected": [rejected], "sampled": [part.num_rows]}
                    )

    measured = sample.mapInArrow(measure, "i long, seconds double, rejected long, sampled long")
    return measured.groupBy("i").agg(
        F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"), F.sum("sampled").alias("sampled")
    )


def ordered_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> list[Rule]:
    """The rules by rejections per second on the sample, best first (ties: as given)."""
    stats = {r["i"]: r["rejected"] / max(r["seconds"], 1e-9) for r in rule_stats(docs, rules, text_col).collect()}
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-stats.get(i, 0.0), i))]


def keep_good(docs: DataFrame, rules: Sequence[Rule] | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) whose text passes every rule."""
    chosen = list(rules) if rules is not None else ordered_rules(docs, RULES, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(cascade(part.column(text_col), chosen)))

    return docs.mapInArrow(run, docs.schema)


def score_quality(
    docs: DataFrame, rules: Sequence[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, the metrics of the whole text, ``kept`` by the cascade."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    chosen = list(rules) if rules is not None else ordered_rules(docs)
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in METRICS) + ", kept boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text")
                features = Features(texts)
                out = {"doc_id": part.column("doc_id")} | {m: pa.array(features[m]) for m in METRICS}
                yield pa.RecordBatch.from_pydict(out | {"kept": pa.array(cascade(texts, chosen))})

    return docs.mapInArrow(run, schema)


def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its metrics, the base verdict and the cascade's verdict."""
    scored = score_quality(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select(
        "doc_id", *METRICS, failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept")
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), m AS (
  SELECT rid, doc_id, len(ws) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols
  FROM w
), li AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
  GROUP BY rid
), g AS (
  SELECT rid, i, [ws[i], ws[i + 1], ws[i + 2]] AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1
), rw AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid
), a AS (
  SELECT m.*, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM m LEFT JOIN li USING (rid) LEFT JOIN rw USING (rid)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
            OR 10 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR 100 * n_dup_lines > 30 * n_lines) AS kept
FROM a
"""
