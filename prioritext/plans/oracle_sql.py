"""DuckDB twins of the registered queries (the correctness oracle).

Each string runs on DuckDB over the same parquet tables, pre-registered as
views.  Shared pieces (the labelled corpus, the request log binding) are
CTE builders so every query states the same binding once.

Regex dialect note: DuckDB's RE2 treats ``\\b`` as an ASCII word boundary,
so the twin first maps accented Latin letters to ``x``; Java's ``\\b`` is
Unicode-aware.  Totals then agree with Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from prioritext.constants import (
    DEFAULT_DURATION_BUCKETS,
    DISPLAY_NAMES,
    EQUIVALENCE_MIN_PCT,
    GATE_MACRO_F1_MIN,
    GATE_RECALL_URGENT_MIN,
    HIGH_QUANTILE,
    LOW_QUANTILE,
    REQUEST_DURATION_BUCKETS,
)
from prioritext.functions.text import term_alternation
from prioritext.sources.tables import (
    EVENT_ENDPOINTS,
    LANG_CATEGORIES,
    OTHER_METHOD,
    PAGE_ROUTES,
    REQUEST_LABEL_BANDS,
    REQUEST_LABEL_TOP,
    STANDIN_LOWERING,
    STANDIN_RAISING,
)

LATIN_FOLD = "regexp_replace({t}, '[À-ÖØ-öø-ɏ]', 'x', 'g')"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def hits_sql(text: str, terms: Sequence[str]) -> str:
    folded = LATIN_FOLD.format(t=text)
    return f"len(regexp_extract_all({folded}, {sql_str('(?i)\\b(?:' + term_alternation(terms) + ')\\b')}))"


def presence_sql(text: str, terms: Sequence[str]) -> str:
    folded = LATIN_FOLD.format(t=text)
    pat = sql_str("(?i)\\b(?:" + term_alternation(terms) + ")\\b")
    # fold first, then extract: distinct matched terms, case-insensitively
    return f"len(list_distinct(list_transform(regexp_extract_all({folded}, {pat}), lambda x: lower(x))))"


def categories_values(without: Sequence[str] = ()) -> str:
    rows = ", ".join(
        f"({sql_str(k)}, {sql_str(n)}, CAST({p!r} AS DOUBLE))" for k, n, p in LANG_CATEGORIES if k not in without
    )
    return f"(VALUES {rows}) AS c(condition_label, condition_name, prior)"


def split_sql(doc_id: str = "doc_id") -> str:
    return f"CASE WHEN {doc_id} % 5 = 0 THEN 'test' ELSE 'train' END"


def band_sql(score: str, low: str, high: str) -> str:
    return f"CASE WHEN {score} < {low} THEN 'normal' WHEN {score} < {high} THEN 'atencao' ELSE 'urgente' END"


def labelled_ctes() -> str:
    """CTEs ``scored``, ``th`` and ``labelled`` (the label_documents result)."""
    return f"""
scored AS (
  SELECT d.doc_id, d.text, d.lang AS condition_label, c.condition_name, c.prior,
         {split_sql('d.doc_id')} AS split,
         CAST({hits_sql('d.text', STANDIN_RAISING)} - {hits_sql('d.text', STANDIN_LOWERING)} AS DOUBLE)
           + coalesce(c.prior, 0.0) AS urgency_score
  FROM documents d LEFT JOIN {categories_values()} ON d.lang = c.condition_label
),
th AS (
  SELECT quantile_cont(urgency_score, {LOW_QUANTILE}) AS low,
         quantile_cont(urgency_score, {HIGH_QUANTILE}) AS high
  FROM scored WHERE split = 'train'
),
labelled AS (
  SELECT printf('%s-%06d', split, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1) AS id,
         doc_id, text, condition_label, condition_name, urgency_score,
         {band_sql('urgency_score', 'th.low', 'th.high')} AS label, split
  FROM scored, th
)"""


def pairs_ctes() -> str:
    """``labelled`` plus ``pairs``: truth = label, prediction = presence variant
    banded by thresholds fitted on its own train scores."""
    return f"""{labelled_ctes()},
variant AS (
  SELECT l.doc_id, l.split, l.label AS y_true,
         CAST({presence_sql('l.text', STANDIN_RAISING)} - {presence_sql('l.text', STANDIN_LOWERING)} AS DOUBLE)
           + coalesce(c.prior, 0.0) AS presence_score
  FROM labelled l LEFT JOIN {categories_values()} ON l.condition_label = c.condition_label
),
vth AS (
  SELECT quantile_cont(presence_score, {LOW_QUANTILE}) AS low,
         quantile_cont(presence_score, {HIGH_QUANTILE}) AS high
  FROM variant WHERE split = 'train'
),
pairs AS (
  SELECT doc_id, split, y_true, {band_sql('presence_score', 'vth.low', 'vth.high')} AS y_pred
  FROM variant, vth
)"""


def request_log_cte() -> str:
    ep = " ".join(f"WHEN {sql_str(t)} THEN {sql_str(e)}" for t, e, _ in EVENT_ENDPOINTS)
    me = " ".join(f"WHEN {sql_str(t)} THEN {sql_str(m)}" for t, _, m in EVENT_ENDPOINTS)
    lab = " ".join(f"WHEN k < {b} THEN {sql_str(n)}" for b, n in REQUEST_LABEL_BANDS)
    return f"""
ev AS (
  SELECT *, TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k FROM events
),
log AS (
  SELECT event_id, ts, user_id, event_type, k,
         CASE event_type {ep} ELSE 'unmatched' END AS endpoint,
         CASE event_type {me} ELSE {sql_str(OTHER_METHOD)} END AS method,
         CASE WHEN k < 90 THEN 200 WHEN k < 97 THEN 422 ELSE 500 END AS status,
         (CASE WHEN k < 90 THEN 200 WHEN k < 97 THEN 422 ELSE 500 END) = 500 AND event_id % 2 = 0 AS unhandled,
         CASE WHEN user_id % 2 = 0 THEN 'base' ELSE 'new' END AS backend,
         value AS duration_ms, value / 1000.0 AS duration_s,
         CASE {lab} ELSE {sql_str(REQUEST_LABEL_TOP)} END AS label
  FROM ev
)"""


def bounds_values(bounds: Sequence[float]) -> str:
    rows = ", ".join(f"({i}, CAST({b!r} AS DOUBLE))" for i, b in enumerate(bounds))
    rows += f", ({len(bounds)}, CAST('Infinity' AS DOUBLE))"
    return f"(VALUES {rows}) AS b(idx, le)"


def routes_values() -> str:
    rows = ", ".join(f"({sql_str(s)}, {sql_str(r)})" for s, r in PAGE_ROUTES)
    return f"(VALUES {rows}) AS r(segment, route)"


def display_values() -> str:
    rows = ", ".join(f"({sql_str(k)}, {sql_str(v)})" for k, v in DISPLAY_NAMES.items())
    return f"(VALUES {rows}) AS dn(label, display_name)"


__all__ = [
    "DEFAULT_DURATION_BUCKETS",
    "EQUIVALENCE_MIN_PCT",
    "GATE_MACRO_F1_MIN",
    "GATE_RECALL_URGENT_MIN",
    "REQUEST_DURATION_BUCKETS",
    "band_sql",
    "bounds_values",
    "categories_values",
    "display_values",
    "hits_sql",
    "labelled_ctes",
    "pairs_ctes",
    "presence_sql",
    "request_log_cte",
    "routes_values",
    "split_sql",
    "sql_str",
]
