"""DuckDB twin SQL of the registered queries (same column names and types)."""

from __future__ import annotations

from prioritext.constants import (
    DEFAULT_DURATION_BUCKETS,
    DEFAULT_SAMPLES,
    DEFAULT_SEED,
    DEFAULT_WARMUP,
    DISPLAY_NAMES,
    EQUIVALENCE_MIN_PCT,
    GATE_MACRO_F1_MIN,
    GATE_RECALL_URGENT_MIN,
    HIGH_QUANTILE,
    LABELS_SORTED,
    LOW_QUANTILE,
    MAX_FEATURES,
    MIN_DF,
    P50_REDUCTION_MIN_PCT,
    REQUEST_DURATION_BUCKETS,
    TEST_SIZE,
    VALID_LABELS,
)
from prioritext.functions.text import TOKEN_PATTERN  # noqa: F401  (documented twin below)
from prioritext.operators.requestlog import le_label
from prioritext.plans.catalog import MIX_SIZE, RATE_WINDOW, SHORT_WINDOW
from prioritext.plans.oracle_sql import (
    LATIN_FOLD,
    band_sql,
    categories_values,
    hits_sql,
    labelled_ctes,
    pairs_ctes,
    presence_sql,
    request_log_cte,
    routes_values,
    sql_str,
)
from prioritext.sources.tables import STANDIN_LOWERING, STANDIN_RAISING

SQL: dict[str, str] = {}


def _in_list(values) -> str:
    return "(" + ", ".join(sql_str(v) for v in values) + ")"


def hash60_sql(seed: int, key: str) -> str:
    return f"CAST(('0x' || substr(md5('{seed}-' || CAST({key} AS VARCHAR)), 1, 15)) AS BIGINT)"


# Twin of the token rule: maximal runs (>= 2) of letters, digits, underscore,
# over lower-cased, accent-stripped text.
TOKENS_SQL = "regexp_extract_all(strip_accents(lower({t})), '[\\pL\\pN_]{{2,}}')"
NGRAMS_SQL = "list_concat({g}, list_transform(range(1, len({g})), lambda i: {g}[i] || ' ' || {g}[i + 1]))"

# ------------------------------------------------------------ labelling
SQL["label_documents"] = f"""WITH {labelled_ctes()}
SELECT id, text, condition_label, condition_name, urgency_score, label, split FROM labelled"""

SQL["label_counts"] = f"""WITH {labelled_ctes()}
SELECT split, label, count(*) AS n FROM labelled GROUP BY split, label"""

SQL["fit_thresholds"] = f"""WITH {labelled_ctes()}
SELECT low, high, CAST({LOW_QUANTILE} AS DOUBLE) AS q_low, CAST({HIGH_QUANTILE} AS DOUBLE) AS q_high,
       CAST({DEFAULT_SEED} AS BIGINT) AS seed FROM th"""

SQL["validate_documents"] = f"""WITH {labelled_ctes()}
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE text IS NULL OR regexp_full_match(text, '\\s*')) AS n_bad_text,
       count(*) FILTER (WHERE coalesce(CAST(label AS VARCHAR), 'null') NOT IN {_in_list(VALID_LABELS)}) AS n_bad_label
FROM labelled"""

# required columns of the documents contract against the table's own schema
SQL["contract_columns"] = """SELECT r.col AS "column",
       r.col IN (SELECT column_name FROM information_schema.columns WHERE table_name = 'documents') AS present
FROM (VALUES ('doc_id'), ('text'), ('lang'), ('label')) AS r(col)"""

SQL["scan_documents_ranges"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"

SQL["file_order_ids"] = """WITH s AS (
  SELECT doc_id, lang, CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
         row_number() OVER () AS place FROM documents
)
SELECT doc_id, lang, split,
       printf('%s-%06d', split, CAST(row_number() OVER (PARTITION BY split ORDER BY place) - 1 AS BIGINT)) AS id FROM s"""

SQL["scan_documents"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"

# landing twice keeps the first landing: the landed table is the documents table
SQL["land_documents"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"

SQL["dense_ids"] = """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
       printf('%s-%06d', CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END,
              row_number() OVER (PARTITION BY doc_id % 5 = 0 ORDER BY doc_id) - 1) AS id
FROM documents"""

SQL["validate_text"] = """WITH bad AS (
  SELECT doc_id FROM documents WHERE text IS NULL OR regexp_full_match(text, '\\s*')
), first AS (SELECT doc_id FROM bad ORDER BY doc_id LIMIT 5)
SELECT (SELECT count(*) FROM documents) AS n_checked,
       (SELECT count(*) FROM bad) AS n_bad,
       coalesce((SELECT string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) FROM first), '') AS first_bad"""

SQL["validate_labels"] = f"""WITH {labelled_ctes()}
SELECT coalesce(CAST(label AS VARCHAR), 'null') AS label, count(*) AS n,
       coalesce(CAST(label AS VARCHAR), 'null') IN {_in_list(VALID_LABELS)} AS valid
FROM labelled GROUP BY 1"""

SQL["admission"] = """SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars_checked,
       CASE WHEN text IS NULL THEN 'missing' WHEN length(text) < 1 THEN 'too_short'
            WHEN length(text) > 20000 THEN 'too_long' END IS NULL AS admitted,
       CASE WHEN text IS NULL THEN 'missing' WHEN length(text) < 1 THEN 'too_short'
            WHEN length(text) > 20000 THEN 'too_long' END AS reason
FROM documents"""

# the quarantine sink of the scoring stream: the rejected rows of the
# admission rule; one input file is one micro-batch (batch id 0)
SQL["stream_quarantine"] = """SELECT doc_id, n_chars_checked, reason, 'client_error' AS error_type, 0 AS batch_id
FROM (SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars_checked,
             CASE WHEN text IS NULL THEN 'missing' WHEN length(text) < 1 THEN 'too_short'
                  WHEN length(text) > 20000 THEN 'too_long' END AS reason
      FROM documents)
WHERE reason IS NOT NULL"""

_disp = " ".join(f"WHEN {sql_str(k)} THEN {sql_str(v)}" for k, v in DISPLAY_NAMES.items())
SQL["display_labels"] = f"""WITH {labelled_ctes()}
SELECT id, label, CASE label {_disp} END AS display_name FROM labelled"""

SQL["class_balance"] = f"""WITH {labelled_ctes()},
per AS (SELECT label, count(*) AS n FROM labelled GROUP BY label)
SELECT label, n, CAST(sum(n) OVER () AS BIGINT) AS total, round(n / sum(n) OVER (), 6) AS share,
       n / sum(n) OVER () >= 0.15 AS share_ok, sum(n) OVER () >= 2000 AS rows_ok
FROM per"""

SQL["non_ascii_profile"] = """SELECT lang, count(*) AS n_rows,
       count(*) FILTER (WHERE regexp_matches(text, '[^\\x00-\\x7F]')) AS n_non_ascii
FROM documents GROUP BY lang"""

# ------------------------------------------------------------ joins
SQL["unmatched_keys"] = f"""SELECT DISTINCT d.lang AS condition_label
FROM documents d LEFT JOIN {categories_values(without=('es',))} ON d.lang = c.condition_label
WHERE c.condition_label IS NULL"""

SQL["equivalence"] = f"""WITH {pairs_ctes()}
SELECT count(*) AS n, count(*) FILTER (WHERE y_true = y_pred) AS matches,
       round(coalesce(100.0 * count(*) FILTER (WHERE y_true = y_pred) / nullif(count(*), 0), 100.0), 6) AS agreement_pct,
       coalesce(100.0 * count(*) FILTER (WHERE y_true = y_pred) / nullif(count(*), 0), 100.0) >= {EQUIVALENCE_MIN_PCT} AS passed,
       CAST(0 AS BIGINT) AS unpaired
FROM pairs"""

# ------------------------------------------------------------ evaluation
_grid = ", ".join(f"({sql_str(t)}, {sql_str(p)})" for t in LABELS_SORTED for p in LABELS_SORTED)
_labels = ", ".join(sql_str(x) for x in LABELS_SORTED)
_CONF = f"""judged AS (
  SELECT CASE WHEN doc_id % 50 = 11 THEN 'sem_rotulo' ELSE y_true END AS t,
         CASE WHEN doc_id % 50 = 7 THEN 'indefinido' WHEN doc_id % 50 <> 3 THEN y_pred END AS p
  FROM pairs
),
cells AS (
  SELECT CASE WHEN t IN ({_labels}) THEN t END AS y_true, CASE WHEN p IN ({_labels}) THEN p END AS y_pred, count(*) AS n
  FROM judged GROUP BY ALL
),
conf AS (
  SELECT g.y_true, g.y_pred, CAST(coalesce(c.n, 0) AS BIGINT) AS n
  FROM (VALUES {_grid}) AS g(y_true, y_pred)
  LEFT JOIN cells c ON c.y_true = g.y_true AND c.y_pred = g.y_pred
  UNION ALL SELECT y_true, y_pred, n FROM cells WHERE y_true IS NULL OR y_pred IS NULL
),
per AS (
  SELECT l.label,
         sum(CASE WHEN y_true = l.label AND y_pred = l.label THEN n ELSE 0 END) AS tp,
         sum(CASE WHEN y_true = l.label THEN n ELSE 0 END) AS support,
         sum(CASE WHEN y_pred = l.label THEN n ELSE 0 END) AS predicted
  FROM conf, (SELECT DISTINCT y_true AS label FROM conf WHERE y_true IS NOT NULL) l GROUP BY l.label
),
pcm AS (
  SELECT label,
         coalesce(tp / nullif(predicted, 0), 0.0) AS precision,
         coalesce(tp / nullif(support, 0), 0.0) AS recall,
         coalesce(2.0 * tp / nullif(support + predicted, 0), 0.0) AS f1,
         CAST(support AS BIGINT) AS support, tp
  FROM per
),
summ AS (
  SELECT avg(f1) AS macro_f1, coalesce(sum(tp) / nullif((SELECT sum(n) FROM conf), 0), 0.0) AS accuracy,
         coalesce(max(CASE WHEN label = 'urgente' THEN recall END), 0.0) AS recall_urgente,
         CAST((SELECT sum(n) FROM conf) AS BIGINT) AS n_samples
  FROM pcm
)"""

SQL["confusion"] = f"""WITH {pairs_ctes()}, {_CONF}
SELECT y_true, y_pred, n FROM conf"""

SQL["per_class_metrics"] = f"""WITH {pairs_ctes()}, {_CONF}
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM pcm"""

SQL["eval_summary"] = f"""WITH {pairs_ctes()}, {_CONF}
SELECT round(macro_f1, 6) AS macro_f1, round(accuracy, 6) AS accuracy, round(recall_urgente, 6) AS recall_urgente, n_samples
FROM summ"""

SQL["quality_gate"] = f"""WITH {pairs_ctes()}, {_CONF},
chk AS (
  SELECT 'macro_f1' AS metric, macro_f1 AS value, CAST({GATE_MACRO_F1_MIN} AS DOUBLE) AS required FROM summ
  UNION ALL
  SELECT 'recall_urgente', recall_urgente, CAST({GATE_RECALL_URGENT_MIN} AS DOUBLE) FROM summ
)
SELECT metric, round(value, 6) AS value, required, value >= required AS passed,
       CASE WHEN value < required THEN printf('%s %.4f < required %.2f', metric, value, required) END AS failure
FROM chk"""

# ------------------------------------------------------------ latency / load
LOG_CTE = f"""WITH {request_log_cte()}"""

SQL["latency_summary"] = f"""{LOG_CTE}
SELECT backend, count(duration_ms) AS n,
       round(avg(duration_ms), 6) AS mean, round(stddev_pop(duration_ms), 6) AS stdev,
       round(min(duration_ms), 6) AS min,
       round(quantile_cont(duration_ms, 0.5), 6) AS p50, round(quantile_cont(duration_ms, 0.9), 6) AS p90,
       round(quantile_cont(duration_ms, 0.95), 6) AS p95, round(quantile_cont(duration_ms, 0.99), 6) AS p99,
       round(max(duration_ms), 6) AS max,
       round(count(duration_ms) / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0), 6) AS throughput
FROM log GROUP BY backend"""

SQL["latency_median"] = f"""{LOG_CTE}
SELECT backend, round(median(duration_ms), 6) AS median FROM log GROUP BY backend"""

SQL["p50_reduction"] = f"""{LOG_CTE},
s AS (SELECT backend, quantile_cont(duration_ms, 0.5) AS p50 FROM log GROUP BY backend),
a AS (SELECT max(CASE WHEN backend = 'base' THEN p50 END) AS b, max(CASE WHEN backend = 'new' THEN p50 END) AS n FROM s)
SELECT round(b, 6) AS base_value, round(n, 6) AS new_value,
       round((b - n) / nullif(b, 0) * 100.0, 6) AS reduction_pct,
       coalesce((b - n) / nullif(b, 0) * 100.0 >= {P50_REDUCTION_MIN_PCT}, false) AS met
FROM a"""

SQL["load_summary"] = f"""{LOG_CTE}
SELECT count(*) AS requested, count(*) FILTER (WHERE status < 400) AS ok,
       count(*) - count(*) FILTER (WHERE status < 400) AS failed,
       round(avg(duration_ms), 6) AS mean_latency_ms,
       round(coalesce(count(*) FILTER (WHERE status < 400) / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0), 0.0), 6) AS throughput
FROM log"""

# ------------------------------------------------------------ counters / histograms
SQL["requests_total"] = f"""{LOG_CTE}
SELECT endpoint, method, status, count(*) AS n FROM log WHERE endpoint <> '/metrics' GROUP BY ALL"""

SQL["predictions_total"] = f"""WITH {pairs_ctes()}
SELECT y_pred AS label, count(*) AS n FROM pairs GROUP BY 1"""

SQL["errors_total"] = f"""{LOG_CTE}
SELECT endpoint,
       CASE WHEN unhandled THEN 'unhandled_exception' WHEN status < 500 THEN 'client_error' ELSE 'server_error' END AS type,
       count(*) AS n
FROM log WHERE status >= 400 AND endpoint <> '/metrics' GROUP BY ALL"""


def _hist_sql(key: str, bounds) -> str:
    rows = ", ".join(f"({i}, {sql_str(le_label(b))}, CAST({b!r} AS DOUBLE))" for i, b in enumerate(bounds))
    rows += f", ({len(bounds)}, '+Inf', CAST('Infinity' AS DOUBLE))"
    return f"""{LOG_CTE},
keys AS (SELECT {key}, sum(duration_s) AS s, count(duration_s) AS c FROM log GROUP BY {key})
SELECT k.{key}, b.idx, b.le,
       CAST((SELECT count(*) FROM log l WHERE l.{key} = k.{key} AND l.duration_s <= b.bound) AS BIGINT) AS cumulative,
       round(k.s, 6) AS sum, CAST(k.c AS BIGINT) AS count
FROM keys k, (VALUES {rows}) AS b(idx, le, bound)"""


SQL["duration_histogram"] = _hist_sql("endpoint", REQUEST_DURATION_BUCKETS)


def _stream_metrics_sql(bounds, watermark_minutes: int = 10) -> str:
    """Windows the append-mode stream emits: hourly windows whose end is at or
    before the watermark (latest event time minus the delay).  One input file
    is one micro-batch, so no row is late."""
    les = ",\n       ".join(
        f"count(*) FILTER (WHERE duration_s <= CAST({b!r} AS DOUBLE)) AS le_{i}" for i, b in enumerate(bounds)
    )
    return f"""{LOG_CTE},
agg AS (
SELECT time_bucket(INTERVAL '1 hour', ts) AS ws, endpoint,
       count(*) AS requests,
       count(*) FILTER (WHERE status >= 400) AS errors,
       count(*) FILTER (WHERE status >= 400 AND NOT unhandled AND status < 500) AS client_errors,
       count(*) FILTER (WHERE status >= 400 AND NOT unhandled AND status >= 500) AS server_errors,
       count(*) FILTER (WHERE status >= 400 AND unhandled) AS unhandled_exceptions,
       {les},
       round(sum(duration_s), 6) AS duration_sum
FROM log GROUP BY ALL)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(ws + INTERVAL '1 hour', '%Y-%m-%d %H:%M:%S') AS window_end,
       agg.* EXCLUDE (ws)
FROM agg
WHERE ws + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '{watermark_minutes} minutes'"""


SQL["stream_metrics"] = _stream_metrics_sql(REQUEST_DURATION_BUCKETS)
SQL["inference_histogram"] = _hist_sql("backend", DEFAULT_DURATION_BUCKETS)

SQL["model_info"] = f"""{LOG_CTE},
loads AS (SELECT ts, backend, strftime(ts, '%Y%m%d') AS model_version FROM log WHERE endpoint = '/model-info')
SELECT backend, model_version, backend AS model_type, 1.0::DOUBLE AS value
FROM loads ORDER BY ts DESC, backend DESC, model_version DESC LIMIT 1"""

SQL["endpoint_normalize"] = f"""SELECT p.page_id, coalesce(r.route, 'unmatched') AS endpoint
FROM (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^/?#]*)', 1) AS segment,
             regexp_extract(url, '^https?://[^/]+(/[^?#]*)?', 1) AS path FROM pages) p
LEFT JOIN {routes_values()} ON p.segment = r.segment
WHERE coalesce(p.path, '') <> '/metrics'"""

# ------------------------------------------------------------ windows
SQL["predictions_running"] = f"""{LOG_CTE},
h AS (SELECT label, date_trunc('hour', ts) AS hb, count(*) AS n FROM log
      WHERE endpoint IN ('/predict', '/predict/batch') GROUP BY ALL)
SELECT label, strftime(hb, '%Y-%m-%d %H:%M:%S') AS bucket, n,
       CAST(sum(n) OVER (PARTITION BY label ORDER BY hb ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running
FROM h"""

SQL["request_rate"] = f"""{LOG_CTE}
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, endpoint, count(*) AS n,
       round(count(*) / 3600.0, 6) AS rate_per_s
FROM log GROUP BY ALL"""

SQL["counter_increase"] = f"""{LOG_CTE},
smp AS (
  SELECT endpoint, ts, event_id,
         CAST(count(*) OVER (PARTITION BY endpoint, date_trunc('day', ts) ORDER BY ts, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value
  FROM log
),
d AS (
  SELECT endpoint, ts, value, lag(value) OVER (PARTITION BY endpoint ORDER BY ts, event_id) AS prev FROM smp
)
SELECT endpoint, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket,
       round(sum(CASE WHEN prev IS NULL THEN value WHEN value - prev < 0 THEN value ELSE value - prev END), 6) AS increase
FROM d GROUP BY ALL"""

_qb_rows = ", ".join(f"({i}, CAST({b!r} AS DOUBLE))" for i, b in enumerate(REQUEST_DURATION_BUCKETS))
_qb_rows += f", ({len(REQUEST_DURATION_BUCKETS)}, CAST('Infinity' AS DOUBLE))"
SQL["histogram_quantile"] = f"""{LOG_CTE},
hours AS (SELECT DISTINCT date_trunc('hour', ts) AS hb FROM log),
b AS (SELECT * FROM (VALUES {_qb_rows}) AS b(idx, le)),
hc AS (
  SELECT h.hb, b.idx, b.le,
         (SELECT count(*) FROM log l WHERE date_trunc('hour', l.ts) = h.hb AND l.duration_s <= b.le) AS c
  FROM hours h, b
),
win AS (
  SELECT hb, idx, le, sum(c) OVER (PARTITION BY idx ORDER BY hb RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW) AS cum
  FROM hc
),
lagged AS (
  SELECT *, coalesce(lag(cum) OVER (PARTITION BY hb ORDER BY idx), 0) AS prev_cum,
         coalesce(lag(le) OVER (PARTITION BY hb ORDER BY idx), 0.0) AS prev_le,
         max(cum) OVER (PARTITION BY hb) AS total,
         max(CASE WHEN le <> 'Infinity'::DOUBLE THEN le END) OVER (PARTITION BY hb) AS last_finite
  FROM win
),
qs AS (SELECT * FROM (VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.95 AS DOUBLE))) AS q(q)),
hit AS (
  SELECT l.*, qs.q, row_number() OVER (PARTITION BY l.hb, qs.q ORDER BY l.idx) AS rn
  FROM lagged l, qs WHERE l.cum >= qs.q * l.total
)
SELECT strftime(hb, '%Y-%m-%d %H:%M:%S') AS window_end_hour, q,
       round(CASE WHEN total <= 0 THEN NULL
                  WHEN le = 'Infinity'::DOUBLE THEN last_finite
                  WHEN cum = prev_cum THEN le
                  ELSE prev_le + (le - prev_le) * ((q * total - prev_cum) / (cum - prev_cum)) END, 6) AS value
FROM hit WHERE rn = 1"""

SQL["error_ratio"] = f"""{LOG_CTE},
h AS (SELECT date_trunc('hour', ts) AS hb, count(*) FILTER (WHERE status >= 400) AS e, count(*) AS r FROM log GROUP BY 1),
w AS (
  SELECT hb, sum(e) OVER (ORDER BY hb RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW) AS errors,
         sum(r) OVER (ORDER BY hb RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW) AS requests
  FROM h
)
SELECT strftime(hb, '%Y-%m-%d %H:%M:%S') AS window_end_hour, CAST(errors AS BIGINT) AS errors,
       CAST(requests AS BIGINT) AS requests, round(errors / nullif(requests, 0), 6) AS error_ratio
FROM w"""

# Trailing windows on a grid of steps: empty steps between the first and the last count as zeros.
_LES = ", ".join(
    f"count(*) FILTER (WHERE duration_s <= CAST({b!r} AS DOUBLE)) AS le_{i}" for i, b in enumerate(REQUEST_DURATION_BUCKETS)
)
_LE_COLUMNS = [f"le_{i}" for i in range(len(REQUEST_DURATION_BUCKETS))]


def _step_end_sql(step: int) -> str:
    return f"strftime(TIMESTAMP '1970-01-01' + to_seconds((i + 1) * {step}), '%Y-%m-%d %H:%M:%S')"


def _trailing_ctes(size: int, step: int, rows: str = "log") -> str:
    """CTE ``t(i, requests, errors, le_*)``: trailing sums at every step over all labels."""
    frame = f"(ORDER BY i ROWS BETWEEN {size // step - 1} PRECEDING AND CURRENT ROW)"
    sums = ", ".join(
        f"CAST(sum(coalesce({c}, 0)) OVER {frame} AS BIGINT) AS {c}" for c in ("requests", "errors", *_LE_COLUMNS)
    )
    return f"""s AS (
  SELECT CAST(floor(epoch(ts) / {step}) AS BIGINT) AS i, count(*) AS requests,
         count(*) FILTER (WHERE status >= 400) AS errors, {_LES}
  FROM {rows} GROUP BY 1
),
g AS (SELECT unnest(range((SELECT min(i) FROM s), (SELECT max(i) + 1 FROM s))) AS i),
t AS (SELECT i, {sums} FROM g LEFT JOIN s USING (i))"""


def _quantile_sql(q: float) -> str:
    """The quantile of a row of ``t``, bucket by bucket."""
    rank = f"CAST({q} AS DOUBLE) * requests"
    cases, below, low = [], "0", "CAST(0 AS DOUBLE)"
    for c, b in zip(_LE_COLUMNS, REQUEST_DURATION_BUCKETS, strict=True):
        inside = f"{low} + (CAST({b!r} AS DOUBLE) - {low}) * (({rank} - {below}) / ({c} - {below}))"
        cases.append(f"WHEN {c} >= {rank} THEN {inside}")
        below, low = c, f"CAST({b!r} AS DOUBLE)"
    return f"CASE WHEN requests = 0 THEN NULL {' '.join(cases)} ELSE {low} END"


_rate_size, _rate_step = RATE_WINDOW
SQL["trailing_rate"] = f"""{LOG_CTE},
s AS (SELECT endpoint, CAST(floor(epoch(ts) / {_rate_step}) AS BIGINT) AS i, count(*) AS c FROM log GROUP BY ALL),
g AS (SELECT endpoint, unnest(range(a, b + 1)) AS i FROM (SELECT endpoint, min(i) AS a, max(i) AS b FROM s GROUP BY 1)),
t AS (
  SELECT endpoint, i, CAST(sum(coalesce(c, 0)) OVER (PARTITION BY endpoint ORDER BY i
         ROWS BETWEEN {_rate_size // _rate_step - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS n
  FROM g LEFT JOIN s USING (endpoint, i)
)
SELECT endpoint, {_step_end_sql(_rate_step)} AS window_end, n, round(CAST(n AS DOUBLE) / {_rate_size}, 6) AS rate_per_s FROM t"""

SQL["trailing_error_ratio"] = f"""{LOG_CTE},
{_trailing_ctes(*SHORT_WINDOW)}
SELECT {_step_end_sql(SHORT_WINDOW[1])} AS window_end, errors, requests,
       round(CAST(errors AS DOUBLE) / nullif(requests, 0), 6) AS error_ratio FROM t"""

SQL["trailing_quantiles"] = " UNION ALL ".join(
    f"""SELECT * FROM ({LOG_CTE},
{_trailing_ctes(*SHORT_WINDOW)}
SELECT {_step_end_sql(SHORT_WINDOW[1])} AS window_end, CAST({q} AS DOUBLE) AS q, round({_quantile_sql(q)}, 6) AS value FROM t)"""
    for q in (0.5, 0.95)
)

# Only windows that the watermark (ten minutes behind the latest event) has closed are in the sink.
_stream_size, _stream_step = RATE_WINDOW
SQL["stream_rates"] = f"""{LOG_CTE},
closed AS (
  SELECT * FROM log WHERE time_bucket(INTERVAL '{_stream_step} seconds', ts) + INTERVAL '{_stream_step} seconds'
                          <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'
),
{_trailing_ctes(_stream_size, _stream_step, "closed")}
SELECT {_step_end_sql(_stream_step)} AS window_end, requests, errors,
       round(CAST(requests AS DOUBLE) / {_stream_size}, 6) AS rate_per_s,
       round(CAST(errors AS DOUBLE) / nullif(requests, 0), 6) AS error_ratio,
       round({_quantile_sql(0.5)}, 6) AS p50, round({_quantile_sql(0.95)}, 6) AS p95
FROM t"""

# Every window that overlaps a step with requests and that the watermark has closed.
SQL["stream_sliding"] = f"""{LOG_CTE},
s AS (
  SELECT CAST(floor(epoch(ts) / {_stream_step}) AS BIGINT) AS j, count(*) AS requests,
         count(*) FILTER (WHERE status >= 400) AS errors, {_LES}
  FROM log GROUP BY 1
),
t AS (
  SELECT i, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("requests", "errors", *_LE_COLUMNS))}
  FROM (SELECT unnest(range(j, j + {_stream_size // _stream_step})) AS i, s.* FROM s) GROUP BY i
)
SELECT strftime(TIMESTAMP '1970-01-01' + to_seconds((i + 1) * {_stream_step} - {_stream_size}), '%Y-%m-%d %H:%M:%S') AS window_start,
       {_step_end_sql(_stream_step)} AS window_end, requests, errors,
       round(CAST(requests AS DOUBLE) / {_stream_size}, 6) AS rate_per_s,
       round(CAST(errors AS DOUBLE) / requests, 6) AS error_ratio,
       round({_quantile_sql(0.5)}, 6) AS p50, round({_quantile_sql(0.95)}, 6) AS p95
FROM t
WHERE TIMESTAMP '1970-01-01' + to_seconds((i + 1) * {_stream_step}) <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'"""

# The batch counters of the whole log: what a stream that was stopped and started again has to show.
_BUCKET_ROWS = " UNION ALL ".join(
    f"SELECT 'request_duration_bucket', 'endpoint=' || endpoint || ',le={le}', "
    f"count(*) FILTER (WHERE {'duration_s IS NOT NULL' if le == '+Inf' else f'duration_s <= CAST({le} AS DOUBLE)'}) FROM l GROUP BY endpoint"
    for le in [*(le_label(b) for b in REQUEST_DURATION_BUCKETS), "+Inf"]
)
SQL["running_series"] = f"""{LOG_CTE},
l AS (SELECT * FROM log WHERE endpoint <> '/metrics')
SELECT metric, series, round(CAST(value AS DOUBLE), 6) AS value FROM (
SELECT 'requests_total' AS metric, 'endpoint=' || endpoint || ',method=' || coalesce(method, 'null') || ',status=' || coalesce(CAST(status AS VARCHAR), 'null') AS series,
       CAST(count(*) AS DOUBLE) AS value FROM l GROUP BY endpoint, method, status UNION ALL
SELECT 'errors_total', 'endpoint=' || endpoint || ',type=' ||
       CASE WHEN unhandled THEN 'unhandled_exception' WHEN status < 500 THEN 'client_error' ELSE 'server_error' END AS s,
       count(*) FROM l WHERE status >= 400 GROUP BY s UNION ALL
SELECT 'predictions_total', 'label=' || coalesce(label, 'null') AS s, count(*) FROM l WHERE endpoint IN ('/predict', '/predict/batch') GROUP BY s UNION ALL
{_BUCKET_ROWS} UNION ALL
SELECT 'request_duration_count', 'endpoint=' || endpoint, count(duration_s) FROM l GROUP BY endpoint UNION ALL
SELECT 'request_duration_sum', 'endpoint=' || endpoint, coalesce(sum(duration_s), 0) FROM l GROUP BY endpoint)"""

# ------------------------------------------------------------ sampling
_N_DRAWS = DEFAULT_SAMPLES + DEFAULT_WARMUP
_SWR = f"""pool AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents),
pn AS (SELECT count(*) AS n FROM documents),
slots AS (SELECT range AS slot FROM range({_N_DRAWS})),
draws AS (
  SELECT s.slot, p.doc_id FROM slots s, pn JOIN pool p ON p.idx = {hash60_sql(DEFAULT_SEED, 's.slot')} % pn.n
)"""

SQL["sample_with_replacement"] = f"""WITH {_SWR}
SELECT slot, doc_id FROM draws"""

SQL["warmup_split"] = f"""WITH {_SWR}
SELECT slot, doc_id, CASE WHEN slot < {DEFAULT_WARMUP} THEN 'warmup' ELSE 'measured' END AS phase FROM draws"""

SQL["sample_without_replacement"] = f"""SELECT doc_id, lang FROM documents
ORDER BY {hash60_sql(DEFAULT_SEED, 'doc_id')}, doc_id LIMIT {DEFAULT_SAMPLES}"""

SQL["stratified_split"] = f"""WITH {labelled_ctes()},
cnt AS (SELECT label, count(*) AS n_c FROM labelled GROUP BY label),
tot AS (SELECT sum(n_c) AS n, CAST(ceil({TEST_SIZE} * sum(n_c)) AS BIGINT) AS n_test FROM cnt),
q0 AS (
  SELECT label, n_c, (n_c * n_test) // n AS base_q, (n_c * n_test) % n AS rem, n_test FROM cnt, tot
),
q AS (
  SELECT label, base_q + CASE WHEN row_number() OVER (ORDER BY rem DESC, label)
                              <= n_test - sum(base_q) OVER () THEN 1 ELSE 0 END AS quota
  FROM q0
),
ranked AS (
  SELECT l.id, l.label, row_number() OVER (PARTITION BY l.label ORDER BY {hash60_sql(DEFAULT_SEED, 'l.id')}, l.id) AS rn
  FROM labelled l
)
SELECT r.id, r.label, CASE WHEN r.rn <= q.quota THEN 'test' ELSE 'train' END AS fold
FROM ranked r JOIN q ON r.label = q.label"""

_classes_sorted = sorted(VALID_LABELS)
SQL["balanced_mix"] = f"""WITH {labelled_ctes()},
pool AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY id) - 1 AS idx FROM labelled
         WHERE label IN {_in_list(_classes_sorted)}),
cnt AS (SELECT label, count(*) AS n_c FROM pool GROUP BY label),
present AS (SELECT label, n_c, row_number() OVER (ORDER BY label) - 1 AS ci FROM cnt),
par AS (SELECT greatest({MIX_SIZE} // {len(_classes_sorted)}, 1) AS take, (SELECT count(*) FROM present) AS k),
base AS (
  SELECT r.range AS pos, pr.label, r.range % par.take AS j, pr.n_c
  FROM par, range((SELECT take * k FROM par)) r JOIN present pr ON pr.ci = r.range // (SELECT take FROM par)
),
basep AS (
  SELECT b.pos, b.label, p.id
  FROM base b JOIN pool p ON p.label = b.label
   AND p.idx = {hash60_sql(DEFAULT_SEED, "b.label || '-' || CAST(b.j AS VARCHAR)")} % b.n_c
),
bl AS (SELECT count(*) AS n FROM basep),
top AS (
  SELECT r.range AS pos, {hash60_sql(DEFAULT_SEED, "'top-' || CAST(r.range AS VARCHAR)")} % bl.n AS src
  FROM bl, range((SELECT n FROM bl), greatest({MIX_SIZE}, (SELECT n FROM bl))) r
),
picks AS (
  SELECT pos, label, id FROM basep WHERE pos < {MIX_SIZE}
  UNION ALL
  SELECT t.pos, b.label, b.id FROM top t JOIN basep b ON b.pos = t.src
)
SELECT pos, label, id, {hash60_sql(DEFAULT_SEED, "'mix-' || CAST(pos AS VARCHAR)")} AS order_key FROM picks"""

# ------------------------------------------------------------ text functions
SQL["lexicon_hits"] = f"""SELECT doc_id, {hits_sql('text', STANDIN_RAISING)} AS raising_hits,
       {hits_sql('text', STANDIN_LOWERING)} AS lowering_hits FROM documents"""

SQL["urgency_score"] = f"""WITH {labelled_ctes()}
SELECT doc_id, urgency_score FROM scored"""

_tok = TOKENS_SQL.format(t="d.text")
SQL["score_variants"] = f"""WITH {labelled_ctes()},
v AS (
  SELECT s.doc_id, s.urgency_score, coalesce(s.prior, 0.0) AS prior,
         {hits_sql('s.text', STANDIN_RAISING)} - {hits_sql('s.text', STANDIN_LOWERING)} AS diff,
         {presence_sql('s.text', STANDIN_RAISING)} - {presence_sql('s.text', STANDIN_LOWERING)} AS pres,
         len(regexp_extract_all(s.text, '[^ \\t\\n\\r]+')) AS words,
         len(list_distinct({TOKENS_SQL.format(t='s.text')})) AS uniq
  FROM scored s
)
SELECT doc_id, urgency_score,
       round(diff / nullif(words, 0) + prior, 6) AS per_word_score,
       round(pres / sqrt(nullif(uniq, 0)) + prior, 6) AS presence_sqrt_score,
       round(CAST(pres AS DOUBLE) + prior, 6) AS presence_score
FROM v"""

SQL["normalize_text"] = "SELECT doc_id, strip_accents(lower(text)) AS normalized FROM documents"

SQL["tokens"] = f"""SELECT doc_id, CAST(len({TOKENS_SQL.format(t='text')}) AS BIGINT) AS n_tokens,
       array_to_string({TOKENS_SQL.format(t='text')}, ' ') AS tokens FROM documents"""

SQL["ngrams"] = f"""WITH t AS (SELECT doc_id, {TOKENS_SQL.format(t='text')} AS g FROM documents),
n AS (SELECT doc_id, {NGRAMS_SQL.format(g='g')} AS grams FROM t)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_grams, array_to_string(grams, '|') AS grams FROM n"""

# ------------------------------------------------------------ features
VOCAB_CTES = f"""t AS (SELECT doc_id, {TOKENS_SQL.format(t='text')} AS g FROM documents),
n AS (SELECT doc_id, {NGRAMS_SQL.format(g='g')} AS grams FROM t),
dt AS (SELECT doc_id, term, count(*) AS c FROM (SELECT doc_id, unnest(grams) AS term FROM n) GROUP BY ALL),
ntrain AS (SELECT count(*) AS n FROM documents WHERE doc_id % 5 <> 0),
st AS (SELECT term, sum(c) AS tf, count(*) AS df FROM dt WHERE doc_id % 5 <> 0 GROUP BY term),
top AS (SELECT * FROM st WHERE df >= {MIN_DF} ORDER BY tf DESC, term ASC LIMIT {MAX_FEATURES}),
vocab AS (
  SELECT term, CAST(tf AS BIGINT) AS tf, CAST(df AS BIGINT) AS df,
         CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx,
         ln((1.0 + ntrain.n) / (1.0 + df)) + 1.0 AS idf
  FROM top, ntrain
)"""

SQL["vocab_topk"] = f"""WITH {VOCAB_CTES}
SELECT term, tf, df, idx FROM vocab"""

SQL["idf"] = f"""WITH {VOCAB_CTES}
SELECT term, df, round(idf, 6) AS idf FROM vocab"""

SQL["tfidf_weights"] = f"""WITH {VOCAB_CTES},
w AS (SELECT dt.doc_id, dt.term, dt.c * v.idf AS w FROM dt JOIN vocab v ON v.term = dt.term)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w"""

SQL["class_weights"] = f"""WITH {labelled_ctes()},
per AS (SELECT label, count(*) AS n_c FROM labelled WHERE split = 'train' GROUP BY label)
SELECT label, n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS weight FROM per"""


def oracle_sql() -> dict[str, str]:
    from prioritext.plans.artefact_sql import SQL as more

    return SQL | more


_ = (LATIN_FOLD, band_sql)  # shared helpers re-exported for tests


def _linear_sql() -> str:
    from prioritext.plans.model_queries import LINEAR_INTERCEPTS

    rows = [f"({sql_str(t)}, 0.0, 0.0, 1.0)" for t in STANDIN_RAISING]
    rows += [f"({sql_str(t)}, 0.0, 1.0, 0.0)" for t in STANDIN_LOWERING]
    (c0, b0), (c1, b1), (c2, b2) = LINEAR_INTERCEPTS
    return f"""WITH t AS (SELECT doc_id, {TOKENS_SQL.format(t='text')} AS g FROM documents),
dt AS (SELECT doc_id, term, count(*) AS c FROM (SELECT doc_id, unnest(g) AS term FROM t) GROUP BY ALL),
coef AS (SELECT * FROM (VALUES {', '.join(rows)}) AS coef(term, w0, w1, w2)),
z AS (SELECT doc_id, sum(c * w0) AS z0, sum(c * w1) AS z1, sum(c * w2) AS z2 FROM dt JOIN coef USING (term) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, coalesce(z.z0, 0.0) + {b0!r} AS a, coalesce(z.z1, 0.0) + {b1!r} AS b, coalesce(z.z2, 0.0) + {b2!r} AS c
  FROM documents d LEFT JOIN z ON z.doc_id = d.doc_id
),
e AS (SELECT doc_id, exp(a - greatest(a, b, c)) AS ea, exp(b - greatest(a, b, c)) AS eb, exp(c - greatest(a, b, c)) AS ec FROM base),
p AS (SELECT doc_id, ea / (ea + eb + ec) AS pa, eb / (ea + eb + ec) AS pb, ec / (ea + eb + ec) AS pc FROM e)
SELECT doc_id,
       CASE WHEN pc > greatest(pa, pb) THEN {sql_str(c2)} WHEN pb > pa THEN {sql_str(c1)} ELSE {sql_str(c0)} END AS label,
       round(pa, 6) AS p_{c0}, round(pb, 6) AS p_{c1}, round(pc, 6) AS p_{c2}
FROM p"""


SQL["linear_score"] = _linear_sql()

# ------------------------------------------------------------ model results that the data alone decide
SIZES_CTE = f"sizes AS (SELECT count(*) AS n, CAST(ceil({TEST_SIZE} * count(*)) AS BIGINT) AS n_test FROM documents)"

SQL["backend_equivalence"] = f"""WITH {SIZES_CTE}
SELECT n_test AS n, n_test AS matches, CAST(100 AS DOUBLE) AS agreement_pct, true AS passed, CAST(0 AS BIGINT) AS unpaired
FROM sizes"""

SQL["missing_artifacts"] = "SELECT 'calibration' AS artifact"

# the gate passes on the given tables: its verdict on the trained model is tested by itself
SQL["end_to_end_job"] = f"""WITH {SIZES_CTE}
SELECT 'land' AS stage, 'ok' AS status, n AS rows FROM sizes UNION ALL
SELECT 'build', 'ok', n FROM sizes UNION ALL
SELECT 'train', 'ok', n - n_test FROM sizes UNION ALL
SELECT 'evaluate', 'ok', n_test FROM sizes UNION ALL
SELECT 'publish', 'ok', 7 FROM sizes"""

# three runs over one folder: the first one's gate fails, the second goes on behind training, the third finds all done
_RUNS = (
    (1, ("ok", "ok", "ok", "failed", "skipped")),
    (2, ("kept", "kept", "kept", "ok", "ok")),
    (3, ("kept", "kept", "kept", "kept", "kept")),
)
_STAGE_ROWS = (("land", "n"), ("build", "n"), ("train", "n - n_test"), ("evaluate", "n_test"), ("publish", "7"))
SQL["job_resume"] = f"WITH {SIZES_CTE}\n" + " UNION ALL ".join(
    f"SELECT CAST({run} AS INTEGER) AS run, '{stage}' AS stage, '{status}' AS status, "
    f"CAST({'NULL' if status == 'skipped' else rows} AS BIGINT) AS rows FROM sizes"
    for run, statuses in _RUNS
    for (stage, rows), status in zip(_STAGE_ROWS, statuses, strict=True)
)

SQL["published_versions"] = """
SELECT 'by_lang' AS artifact, CAST(2 AS INTEGER) AS version, count(*) AS n_rows, 'none' AS problem FROM (SELECT DISTINCT lang FROM documents)
UNION ALL SELECT 'by_source', 2, count(*), 'none' FROM (SELECT DISTINCT source FROM documents)
UNION ALL SELECT 'lengths', 2, count(*), 'changed' FROM documents"""

_FINGERPRINTED = {
    c: f"CAST({c} AS DECIMAL(38, 6))" if c == "urgency_score" else c
    for c in ("id", "text", "condition_label", "condition_name", "urgency_score", "label", "split")
}
_FIELDS = ", ".join(f"coalesce('=' || CAST({v} AS VARCHAR), 'null')" for v in _FINGERPRINTED.values())
SQL["table_fingerprint"] = f"""WITH {labelled_ctes()},
h AS (SELECT CAST('0x' || substr(md5(concat_ws(chr(31), {_FIELDS})), 1, 15) AS BIGINT) AS h FROM labelled)
SELECT count(*) AS n_rows, bit_xor(h) AS xor_hash, CAST(sum(CAST(h AS HUGEINT)) AS VARCHAR) AS sum_hash FROM h"""
