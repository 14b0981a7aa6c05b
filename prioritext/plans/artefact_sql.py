"""DuckDB twins of the queries over model certificates, fixed TF-IDF models and written artefacts."""

from __future__ import annotations

from prioritext.constants import EQUIVALENCE_MIN_PCT, P50_REDUCTION_MIN_PCT
from prioritext.plans.catalog_sql import LOG_CTE, SIZES_CTE, VOCAB_CTES
from prioritext.plans.model_queries import FIXED_LOWERING, FIXED_RAISING, LINEAR_INTERCEPTS, PATH_C
from prioritext.plans.oracle_sql import labelled_ctes, pairs_ctes, sql_str
from prioritext.sources.tables import STANDIN_LOWERING, STANDIN_RAISING

SQL: dict[str, str] = {}

_COEF = ", ".join(
    f"({sql_str(t)}, {w[1]!r}, {w[2]!r})"
    for terms, w in ((STANDIN_RAISING, FIXED_RAISING), (STANDIN_LOWERING, FIXED_LOWERING))
    for t in terms
)
(_C0, _B0), (_C1, _B1), (_C2, _B2) = LINEAR_INTERCEPTS
_SCORED = f"""{VOCAB_CTES},
w AS (SELECT dt.doc_id, dt.term, dt.c * v.idf AS w FROM dt JOIN vocab v ON v.term = dt.term),
x AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS x FROM w),
coef AS (SELECT * FROM (VALUES {_COEF}) AS coef(term, w1, w2)),
z AS (SELECT doc_id, sum(x * w1) AS z1, sum(x * w2) AS z2 FROM x JOIN coef USING (term) GROUP BY doc_id),
e AS (
  SELECT d.doc_id, exp({_B0!r}) AS ea, exp({_B1!r} + coalesce(z1, 0.0)) AS eb, exp({_B2!r} + coalesce(z2, 0.0)) AS ec
  FROM documents d LEFT JOIN z ON z.doc_id = d.doc_id
),
p AS (SELECT doc_id, ea / (ea + eb + ec) AS pa, eb / (ea + eb + ec) AS pb, ec / (ea + eb + ec) AS pc FROM e)"""

SQL["score_text_fixed"] = f"""WITH {_SCORED}
SELECT doc_id,
       CASE WHEN pc > greatest(pa, pb) THEN {sql_str(_C2)} WHEN pb > pa THEN {sql_str(_C1)} ELSE {sql_str(_C0)} END AS label,
       round(pa, 6) AS p_{_C0}, round(pb, 6) AS p_{_C1}, round(pc, 6) AS p_{_C2}
FROM p"""

SQL["loss_gradient"] = f"""WITH {labelled_ctes()}, {_SCORED},
tr AS (
  SELECT doc_id, label, count(*) OVER () / (3.0 * count(*) OVER (PARTITION BY label)) AS s FROM labelled WHERE split = 'train'
),
r AS (
  SELECT tr.doc_id,
         s * (pa - CASE WHEN label = {sql_str(_C0)} THEN 1 ELSE 0 END) AS ra,
         s * (pb - CASE WHEN label = {sql_str(_C1)} THEN 1 ELSE 0 END) AS rb,
         s * (pc - CASE WHEN label = {sql_str(_C2)} THEN 1 ELSE 0 END) AS rc
  FROM tr JOIN p ON p.doc_id = tr.doc_id
),
g AS (
  SELECT term, sum(x * ra) AS a, sum(x * rb) AS b, sum(x * rc) AS c FROM x JOIN r ON r.doc_id = x.doc_id GROUP BY term
  UNION ALL
  SELECT '(intercept)', sum(ra), sum(rb), sum(rc) FROM r
)
SELECT term, round(a, 6) + 0.0 AS g_{_C0}, round(b, 6) + 0.0 AS g_{_C1}, round(c, 6) + 0.0 AS g_{_C2} FROM g"""

# the optimum of a convex objective doesn't depend on who looks for it: the verdicts are known beforehand
SQL["train_certificate"] = f"""WITH {SIZES_CTE}
SELECT n - n_test AS n_docs, true AS optimal FROM sizes"""

SQL["regularisation_path"] = f"""WITH {SIZES_CTE}
SELECT CAST({PATH_C!r} AS DOUBLE) AS c, n - n_test AS n_docs, true AS optimal,
       CAST(NULL AS BOOLEAN) AS loss_falls, CAST(NULL AS BOOLEAN) AS coefficients_grow FROM sizes
UNION ALL SELECT CAST(0.1 AS DOUBLE), n - n_test, true, true, true FROM sizes"""

SQL["dimension_scan"] = """WITH d AS (
  SELECT lang, lang || ', "' || min(source) || '"' || chr(10) || 'source' AS condition_name FROM documents
  WHERE lang <> (SELECT max(lang) FROM documents) GROUP BY lang
)
SELECT coalesce(condition_name, 'unmatched') AS condition_name, count(*) AS n
FROM documents LEFT JOIN d ON d.lang = documents.lang GROUP BY 1"""

SQL["class_order_fallback"] = """WITH c AS (
  SELECT string_agg(DISTINCT lang, ',' ORDER BY lang) AS classes, 'over ' || count(*) AS v FROM documents
)
SELECT 'full' AS folder, v AS model_version, classes, 'metadata' AS classes_from FROM c
UNION ALL SELECT 'unnamed', v, classes, 'classes' FROM c
UNION ALL SELECT 'bare', 'unknown', classes, 'classes' FROM c"""

_STATS = ", ".join(
    f"round({f}, 6) AS {c}_{b}"
    for b in ("base", "new")
    for c, f in (
        ("mean", f"avg(duration_ms) FILTER (WHERE backend = '{b}')"),
        ("p50", f"quantile_cont(duration_ms, 0.5) FILTER (WHERE backend = '{b}')"),
        ("p95", f"quantile_cont(duration_ms, 0.95) FILTER (WHERE backend = '{b}')"),
    )
)
_PCT = "coalesce(100.0 * count(*) FILTER (WHERE y_true = y_pred) / nullif(count(*), 0), 100.0)"
SQL["bench_record"] = f"""{LOG_CTE}, {pairs_ctes()},
s AS (
  SELECT {_STATS}, count(duration_ms) FILTER (WHERE backend = 'base') AS n_base,
         count(duration_ms) FILTER (WHERE backend = 'new') AS n_new FROM log
),
r AS (SELECT (p50_base - p50_new) / nullif(p50_base, 0) * 100.0 AS cut FROM s),
a AS (SELECT count(*) AS n_pairs, {_PCT} AS pct FROM pairs)
SELECT 'given' AS sf, s.*, n_pairs, round(pct, 6) AS agreement_pct, round(cut, 6) AS reduction_pct,
       CASE WHEN pct < {EQUIVALENCE_MIN_PCT} THEN 'not_equivalent' WHEN cut >= {P50_REDUCTION_MIN_PCT} THEN 'keep' ELSE 'not_faster' END AS verdict
FROM s, r, a"""
