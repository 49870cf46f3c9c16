"""DuckDB SQL that states independently what each query has to return."""

from __future__ import annotations

from wearlens.contract import (
    FAILURE_FLAGS, LABEL, RAW_TO_WORKING, REQUIRED_READING, SENSOR_RANGES, SENSORS, feature_names,
)
from wearlens.operators.metrics import SCAN
from wearlens.operators.oplog import LATENCY_BOUNDS

WORKING = ["unit_id", "vehicle_id", "product_id", "type", "recorded_at", *SENSORS, LABEL, *FAILURE_FLAGS, "failure_probability"]

TELEMETRY = """
b AS (
  SELECT event_id, user_id, event_type, value, ts,
         CAST(json_extract_string(props, '$.k') AS int) AS k
  FROM events
), t AS (
  SELECT event_id + 1 AS unit_id, user_id AS vehicle_id,
         CASE WHEN event_id % 79 = 0 THEN 'X' WHEN event_type = 'view' THEN 'M'
              WHEN event_type = 'purchase' THEN 'H' ELSE 'L' END AS type,
         CASE WHEN event_id % 101 = 0 THEN 'not-a-timestamp'
              ELSE substr(CAST(ts AS varchar), 1, 19) END AS recorded_at,
         CASE WHEN event_id % 97 = 0 THEN 9999e-1 ELSE 295e0 + k / 10e0 END AS air_temperature_k,
         305e0 + ((k * 7) % 100) / 125e-1 AS process_temperature_k,
         CASE WHEN event_id % 89 = 0 THEN -500
              ELSE CAST(1300 + (event_id * 37) % 600 AS int) END AS rotational_speed_rpm,
         CASE WHEN event_id % 83 = 0 THEN NULL ELSE value END AS torque_nm,
         CAST(event_id % 254 AS int) AS tool_wear_min, event_id, k, ts
  FROM b
), f AS (
  SELECT t.*, concat(type, lpad(CAST(event_id % 100000 AS varchar), 5, '0')) AS product_id,
         CASE WHEN tool_wear_min > 248 THEN 1 ELSE 0 END AS twf,
         CASE WHEN k > 97 THEN 1 ELSE 0 END AS hdf,
         CASE WHEN torque_nm * rotational_speed_rpm > 250000e0 THEN 1 ELSE 0 END AS pwf,
         CASE WHEN torque_nm > 110e0 AND tool_wear_min > 150 THEN 1 ELSE 0 END AS osf,
         CASE WHEN event_id % 1000 = 0 THEN 1 ELSE 0 END AS rnf
  FROM t
), telemetry AS (
  SELECT *, greatest(twf, hdf, pwf, osf, rnf) AS machine_failure,
         3e-1 * greatest(twf, hdf, pwf, osf, rnf) + 7e-1 * (((event_id * 7919) % 1000) / 1000e0) AS failure_probability
  FROM f
)"""

OK = {c: f"{c} BETWEEN {lo!r} AND {hi!r}" for c, (lo, hi) in SENSOR_RANGES.items()}
CLEAN = TELEMETRY + """, clean AS (
  SELECT * FROM telemetry
  WHERE torque_nm IS NOT NULL AND recorded_at <> 'not-a-timestamp' AND """ + " AND ".join(OK.values()) + "\n)"
SCORED = CLEAN + """, scored AS (
  SELECT unit_id, vehicle_id, type, machine_failure AS label, failure_probability AS score FROM clean
)"""
REQUEST_LOG = """
reqlog AS (
  SELECT event_id AS request_id, ts,
         CASE WHEN event_type = 'signup' THEN '/health' ELSE '/predict' END AS path,
         CASE WHEN event_type = 'error' THEN 500 WHEN event_id % 11 = 0 THEN 422 ELSE 200 END AS status_code,
         value AS duration_ms
  FROM events
)"""


def sql(ctes: str, body: str, doubles=(), stamps=()) -> str:
    """Wrap a query so that doubles are rounded and timestamps are text."""
    text = f"WITH {ctes.strip()} {body.strip()}" if ctes else body.strip()
    parts = [f"round(CAST({c} AS DOUBLE), 6) + 0e0 AS {c}" for c in doubles]
    parts += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in stamps]
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM ({text})" if parts else text


def values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(r) + ")" for r in rows) + ")"


def unpivot(source: str, columns, keep: str = "", cast: str = "DOUBLE") -> str:
    keep = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {keep}'{c}' AS \"column\", CAST({c} AS {cast}) AS value FROM {source}" for c in columns
    )


# --- rolling ------------------------------------------------------------------------------


def rolling_exprs(part: str, order: str, windows=(3, 5), which=("rollmean", "rollstd", "roc")) -> str:
    out = []
    for c in SENSORS:
        for w in windows:
            over = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
            if "rollmean" in which:
                out.append(f"avg(CAST({c} AS DOUBLE)) {over} AS {c}_rollmean_w{w}")
            if "rollstd" in which:
                out.append(f"coalesce(stddev_samp(CAST({c} AS DOUBLE)) {over}, 0e0) AS {c}_rollstd_w{w}")
        if "roc" in which:
            out.append(
                f"CAST({c} AS DOUBLE) - coalesce(lag(CAST({c} AS DOUBLE)) OVER (PARTITION BY {part} ORDER BY {order}), "
                f"CAST({c} AS DOUBLE)) AS {c}_roc"
            )
    return ", ".join(out)


def names(windows=(3, 5), which=("rollmean", "rollstd", "roc")) -> list[str]:
    return [n for n in feature_names(windows=windows) if any(f"_{w}" in n for w in which)]


def rolling_sql(which=("rollmean", "rollstd", "roc")) -> str:
    return sql(
        CLEAN, f"SELECT unit_id, type, {rolling_exprs('type', 'tool_wear_min, unit_id', which=which)} FROM clean",
        names(which=which),
    )


# --- metrics --------------------------------------------------------------------------------

CELLS = """count(*) FILTER (label = 0 AND score < {t}) AS tn, count(*) FILTER (label = 0 AND score >= {t}) AS fp,
 count(*) FILTER (label = 1 AND score < {t}) AS fn, count(*) FILTER (label = 1 AND score >= {t}) AS tp"""
RATES = """tn + fp + fn + tp AS n_samples, tp + fn AS n_positive,
 CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp * 1e0 / (tp + fp) END AS "precision",
 CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp * 1e0 / (tp + fn) END AS recall,
 CASE WHEN 5 * tp + 4 * fn + fp = 0 THEN 0e0 ELSE 5e0 * tp / (5 * tp + 4 * fn + fp) END AS f2_score,
 CASE WHEN tp + fn = 0 THEN NULL ELSE fn * 1e0 / (tp + fn) END AS fn_rate,
 CASE WHEN tn + fp = 0 THEN NULL ELSE fp * 1e0 / (tn + fp) END AS fp_rate,
 (5e0 * fn + fp) / (tn + fp + fn + tp) * 1000e0 AS expected_cost_per_1000"""
RATE_NAMES = ['"precision"', "recall", "f2_score", "fn_rate", "fp_rate", "expected_cost_per_1000"]


def report_sql(columns: str = "*", by: str = "", doubles=()) -> str:
    group, key = (f"GROUP BY {by}", f"{by},") if by else ("", "")
    body = f"""SELECT {columns} FROM (
      SELECT *, {RATES}, 27e-2 AS threshold FROM (
        SELECT {key} {CELLS.format(t='27e-2')}, avg((score - label) * (score - label)) AS brier_score FROM scored {group}))"""
    return sql(SCORED, body, doubles)


def ranking_sql(source: str, by: str = "") -> str:
    """Average precision and ROC-AUC per group from windows over the distinct scores."""
    key = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
      SELECT {key} sum(pos * cum_pos * 1e0 / (cum_pos + cum_neg)) / nullif(max(all_pos), 0)
               + CASE WHEN max(all_neg) = 0 THEN NULL ELSE 0 END AS pr_auc,
             sum(CAST(pos AS DOUBLE) * (all_neg - cum_neg + neg / 2e0))
               / nullif(max(all_pos) * max(all_neg), 0) AS roc_auc,
             CASE WHEN max(all_pos) = 0 THEN 'no positives' WHEN max(all_neg) = 0 THEN 'no negatives' END AS reason
      FROM (
        SELECT *, sum(pos) OVER ({part} ORDER BY score DESC) AS cum_pos, sum(neg) OVER ({part} ORDER BY score DESC) AS cum_neg,
               sum(pos) OVER ({part}) AS all_pos, sum(neg) OVER ({part}) AS all_neg
        FROM (SELECT {key} score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg
              FROM {source} GROUP BY {key} score))
      {group}"""




def hash_sql(seed: int, column: str = "unit_id") -> str:
    x = f"(({column} + {column} // 1000003 * 7919 + {seed * 104729}) % 1000003)"
    return f"((({x} * {x}) % 1000003) * (({x} * {x}) % 1000003) % 1000003 * {x} % 1000003)"


SPLIT = SCORED + f""", ranked AS (
  SELECT unit_id, type, label,
         row_number() OVER (PARTITION BY label ORDER BY {hash_sql(42)}, unit_id) - 1 AS pos,
         count(*) OVER (PARTITION BY label) AS n
  FROM scored
), cut AS (SELECT *, (n * 2 + 5) // 10 AS n_test FROM ranked),
split AS (
  SELECT unit_id, type, label,
         CASE WHEN pos < n_test THEN 'test'
              WHEN pos < n_test + (n - n_test + 2) // 4 THEN 'validation' ELSE 'train' END AS split
  FROM cut
)"""
AUDIT = """positives = 0 OR rows = positives OR positives < 5 AS degenerate,
 CASE WHEN positives = 0 THEN 'no positives' WHEN rows = positives THEN 'no negatives'
      WHEN positives < 5 THEN 'too few positives' END AS reason"""

# --- runs -----------------------------------------------------------------------------------

RUNS = SCORED + f""", cells AS (
  SELECT vehicle_id, thr, i, unit_id % 2 = 1 AS val, {CELLS.format(t='thr')}
  FROM scored, (VALUES (27e-2, 1), (5e-1, 2), (6e-1, 3)) v(thr, i)
  GROUP BY vehicle_id, thr, i, unit_id % 2 = 1
), rated AS (SELECT *, {RATES} FROM cells
), ranks AS ({ranking_sql('(SELECT * FROM scored WHERE unit_id % 2 = 1)', 'vehicle_id')}
), runs AS (
  SELECT concat('run-', v.vehicle_id * 3 + v.i) AS run_id,
         concat('batch-', lpad(CAST(v.vehicle_id // 10 AS varchar), 4, '0')) AS batch_id,
         v.vehicle_id // 10 AS batch_no, v.vehicle_id * 3 + v.i AS seq,
         v.recall AS val_recall, v."precision" AS val_precision, v.f2_score AS val_f2_score,
         v.expected_cost_per_1000 AS val_expected_cost_per_1000,
         t.expected_cost_per_1000 AS test_expected_cost_per_1000, r.pr_auc AS val_pr_auc
  FROM rated v
  LEFT JOIN rated t ON v.vehicle_id = t.vehicle_id AND v.i = t.i AND NOT t.val
  LEFT JOIN ranks r ON v.vehicle_id = r.vehicle_id
  WHERE v.val
), best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY CASE WHEN coalesce(val_recall, 0) >= 5e-1 THEN 0 ELSE 1 END,
             val_expected_cost_per_1000, seq) AS rn FROM runs)
  WHERE rn = 1
)"""
RUN_DOUBLES = [
    "val_recall", "val_precision", "val_f2_score", "val_expected_cost_per_1000", "test_expected_cost_per_1000", "val_pr_auc",
]
HISTORY = RUNS + """, candidates AS (
  SELECT batch_id, batch_no, run_id AS candidate_run_id, val_recall AS candidate_recall,
         val_expected_cost_per_1000 AS candidate_cost_per_1000, coalesce(val_recall, 0) >= 5e-1 AS passes_recall_gate,
         batch_no + 1 AS candidate_version
  FROM best
), earlier AS (
  SELECT c.batch_no, p.candidate_version, p.candidate_cost_per_1000,
         row_number() OVER (PARTITION BY c.batch_no ORDER BY p.candidate_cost_per_1000, p.candidate_version) AS rn
  FROM candidates c JOIN candidates p ON p.batch_no < c.batch_no AND p.passes_recall_gate
), history AS (
  SELECT *, passes_recall_gate AND beats_champion AS promoted_to_production,
         CASE WHEN champion_cost_per_1000 IS NULL THEN 'no current production model — first promotion'
              ELSE concat('candidate cost ', format('{:.1f}', candidate_cost_per_1000), '/1000 ',
                   CASE WHEN beats_champion THEN 'beats' ELSE 'does not beat' END,
                   ' production''s ', format('{:.1f}', champion_cost_per_1000), '/1000') END AS reason
  FROM (
    SELECT c.*, e.candidate_version AS champion_version, e.candidate_cost_per_1000 AS champion_cost_per_1000,
           e.candidate_cost_per_1000 IS NULL OR c.candidate_cost_per_1000 < e.candidate_cost_per_1000 AS beats_champion
    FROM candidates c LEFT JOIN earlier e ON c.batch_no = e.batch_no AND e.rn = 1)
), aliases AS (
  SELECT 'staging' AS alias, candidate_version AS version, candidate_version AS seq FROM history
  UNION ALL
  SELECT 'production', candidate_version, candidate_version FROM history WHERE promoted_to_production
)"""

# --- requests ---------------------------------------------------------------------------------

REQUESTS = TELEMETRY + """, readings AS (
  SELECT *, event_id // 8 AS request_id,
         row_number() OVER (PARTITION BY event_id // 8 ORDER BY unit_id) - 1 AS i
  FROM telemetry
), heads AS (
  SELECT request_id, arg_min(type, unit_id) AS type, max(ts) AS ts, count(*) AS n,
         CASE WHEN request_id % 41 = 0 THEN 'empty' WHEN request_id % 43 = 0 THEN 'hot'
              WHEN request_id % 47 = 0 THEN 'anonymous' WHEN request_id % 53 = 0 THEN 'broken' ELSE 'plain' END AS kind
  FROM readings GROUP BY request_id
), errors AS (
  SELECT request_id, 'body' AS loc, 'json_invalid' AS error_type, 'JSON decode error' AS msg FROM heads WHERE kind = 'broken'
  UNION ALL
  SELECT request_id, 'body.telemetry_window', 'too_short', 'List should have at least 1 item after validation, not 0'
  FROM heads WHERE kind = 'empty'
  UNION ALL
  SELECT request_id, 'body.vehicle_id', 'string_too_short', 'String should have at least 1 character'
  FROM heads WHERE kind = 'anonymous'
  UNION ALL
  SELECT request_id, 'body.type', 'enum', 'Input should be ''L'', ''M'' or ''H''' FROM heads WHERE kind <> 'broken' AND type = 'X'
  UNION ALL
  SELECT request_id, concat('body.telemetry_window.', i, '.', c), e[1], e[2] FROM (
    SELECT r.request_id, r.i, s.c,
      CASE WHEN s.c = 'air_temperature_k' AND h.kind = 'hot'
             THEN ['float_parsing', 'Input should be a valid number, unable to parse string as a number']
           WHEN s.x IS NULL THEN ['missing', 'Field required']
           WHEN s.x < s.lo THEN ['greater_than_equal', concat('Input should be greater than or equal to ', CAST(s.lo AS int))]
           WHEN s.x > s.hi THEN ['less_than_equal', concat('Input should be less than or equal to ', CAST(s.hi AS int))] END AS e
    FROM readings r JOIN heads h ON r.request_id = h.request_id AND h.kind NOT IN ('empty', 'broken')
    JOIN (""" + " UNION ALL ".join(
    f"SELECT unit_id, '{c}' AS c, CAST({c} AS DOUBLE) AS x, {lo!r} AS lo, {hi!r} AS hi FROM telemetry"
    for c, (lo, hi) in SENSOR_RANGES.items()
) + """) s ON s.unit_id = r.unit_id) WHERE e IS NOT NULL
)"""

# --- drift ----------------------------------------------------------------------------------

NUMERIC = [*SENSORS, "prediction"]
COLD = {"air_temperature_k": (282, 289, 7), "process_temperature_k": (288, 296, 8)}
COLD_EXPR = {
    c: f"({lo}e0 + {hash_sql(seed)} / 1000003e0 * {hi - lo}e0)"
    for c, (lo, hi, seed) in COLD.items()
}


def drift_ctes(cold: bool = False, windows=None) -> str:
    swap = "* REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in COLD_EXPR.items()) + ")" if cold else "*"
    if windows:
        w = values([(str(m),) for m in windows])
        ref = f"SELECT d.*, v.w FROM d, {w} v(w) WHERE ts < TIMESTAMP '2024-01-16'"
        cur = (
            f"SELECT d.*, v.w FROM d, {w} v(w) WHERE ts >= TIMESTAMP '2024-01-16' AND ts <= TIMESTAMP '2024-01-31' "
            "AND epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts) <= CAST(v.w AS BIGINT) * 60000000"
        )
    else:
        ref = "SELECT *, 0 AS w FROM d WHERE ts < TIMESTAMP '2024-01-16'"
        cur = f"SELECT *, 0 AS w FROM (SELECT {swap} FROM d WHERE ts >= TIMESTAMP '2024-01-16')"
    return CLEAN + f""", d AS (SELECT *, failure_probability AS prediction FROM clean
), ref AS ({ref}), cur AS ({cur}), long AS (
  SELECT w, "column", value, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c FROM (
    SELECT 0 AS side, * FROM ({unpivot('ref', NUMERIC, 'w')}) UNION ALL SELECT 1, * FROM ({unpivot('cur', NUMERIC, 'w')}))
  GROUP BY w, "column", value
), run AS (
  SELECT *, abs(sum(r) OVER (PARTITION BY w, "column" ORDER BY value) * 1e0 / sum(r) OVER (PARTITION BY w, "column")
              - sum(c) OVER (PARTITION BY w, "column" ORDER BY value) * 1e0 / sum(c) OVER (PARTITION BY w, "column")) AS gap,
         lead(value) OVER (PARTITION BY w, "column" ORDER BY value) - value AS dx
  FROM long
), std AS (SELECT "column", stddev_pop(value) AS std FROM ({unpivot('ref', NUMERIC, 'w')}) GROUP BY "column"
), num AS (
  SELECT w, "column", sum(gap * coalesce(dx, 0e0)) / max(greatest(std, 1e-3)) AS wasserstein, max(gap) AS ks,
         CAST(sum(r) AS BIGINT) AS ref_rows, CAST(sum(c) AS BIGINT) AS cur_rows
  FROM run JOIN std USING ("column") GROUP BY w, "column" HAVING sum(r) > 0 AND sum(c) > 0
), cat AS (
  SELECT w, 'type' AS "column", sqrt(greatest(sum(((CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0e0 END)
         + (CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0e0 END)) / 2), 0e0)) AS js,
         CAST(max(nr) AS BIGINT) AS ref_rows, CAST(max(nc) AS BIGINT) AS cur_rows
  FROM (
    SELECT w, r * 1e0 / sum(r) OVER (PARTITION BY w) AS p, c * 1e0 / sum(c) OVER (PARTITION BY w) AS q,
           sum(r) OVER (PARTITION BY w) AS nr, sum(c) OVER (PARTITION BY w) AS nc
    FROM (SELECT w, type, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c FROM (
        SELECT 0 AS side, w, type FROM ref UNION ALL SELECT 1, w, type FROM cur) GROUP BY w, type))
  GROUP BY w HAVING max(nr) > 0 AND max(nc) > 0
), by_column AS (
  SELECT w, "column", 'normalized_wasserstein' AS method, wasserstein AS score, ref_rows, cur_rows, wasserstein >= 1e-1 AS drifted, CAST(NULL AS VARCHAR) AS reason FROM num
  UNION ALL SELECT w, "column", 'jensen_shannon', js, ref_rows, cur_rows, js >= 1e-1, NULL FROM cat
), summary AS (
  SELECT w, count(*) FILTER (drifted) * 1e0 / count(*) AS drift_score, count(*) FILTER (drifted) AS drifted_column_count,
         count(*) AS total_columns, count(*) FILTER (drifted) * 1e0 / count(*) >= 3e-1 AS drift_detected, 3e-1 AS threshold,
         max(ref_rows) AS reference_window_size, max(cur_rows) AS current_window_size, max(cur_rows) >= 100 AS min_rows_ok,
         'ok' AS status
  FROM by_column GROUP BY w
)"""


SUMMARY = ["drift_score", "threshold"]
EXPERIMENTS = [
    (n, 5 if n == "baseline_no_rolling" else 30)
    for n in (
        "baseline_no_rolling", "baseline_rolling", "small_forest", "large_forest", "deep_unbounded", "balanced_subsample",
        "no_class_weight", "minmax_scaler", "isotonic_calibration", "conservative_leaves", "wide_windows", "narrow_windows",
    )
]


def quantile_sql(source: str, value: str, qs, by: str) -> str:
    rows = values([(f"{q!r}::DOUBLE",) for q in qs])
    return f"""SELECT {by}, q, CASE {' '.join(f"WHEN q = {q!r}::DOUBLE THEN x{i}" for i, q in enumerate(qs))} END AS quantile
      FROM (SELECT {by}, {', '.join(f"quantile_cont({value}, {q!r}) AS x{i}" for i, q in enumerate(qs))}
            FROM {source} GROUP BY {by}), {rows} v(q)"""


def oracle_sql() -> dict[str, str]:
    raw = ", ".join(f'{w} AS "{r}"' for r, w in RAW_TO_WORKING.items())
    working = ", ".join(RAW_TO_WORKING.values())
    cols = ", ".join(WORKING)
    sensors = ", ".join(SENSORS)
    reading = ["air_temperature_k", "process_temperature_k", "torque_nm"]
    fault_reasons = ["CASE WHEN torque_nm IS NULL THEN 'missing:torque_nm' END"]
    fault_reasons += ["CASE WHEN recorded_at = 'not-a-timestamp' THEN 'bad_timestamp' END"]
    fault_reasons += [f"CASE WHEN NOT ({t}) THEN 'out_of_range:{c}' END" for c, t in OK.items()]
    fault_reasons += ["CASE WHEN type = 'X' THEN 'bad_category:type' END"]
    outside = {c: f"NOT coalesce({t}, false)" for c, t in OK.items()}
    any_out = " OR ".join(outside.values())
    staged = TELEMETRY + f""", staged AS (
      SELECT *, torque_nm IS NULL AS miss, recorded_at = 'not-a-timestamp' AS bad, {any_out} AS outlier FROM telemetry)"""
    items = [
        ("rows_in", "count(*)"),
        ("dropped_missing", "count(*) FILTER (miss)"),
        ("dropped_bad_timestamp", "count(*) FILTER (NOT miss AND bad)"),
        ("dropped_outliers", "count(*) FILTER (NOT miss AND NOT bad AND outlier)"),
        ("rows_out", "count(*) FILTER (NOT miss AND NOT bad AND NOT outlier)"),
        ("dropped_total", "count(*) FILTER (miss OR bad OR outlier)"),
        ("null:torque_nm", "count(*) FILTER (miss)"),
        *[(f"range:{c}", f"count(*) FILTER (NOT miss AND NOT bad AND {t})") for c, t in outside.items()],
    ]
    doubled = TELEMETRY + """, doubled AS (
      SELECT * FROM telemetry UNION ALL SELECT * FROM telemetry WHERE unit_id % 500 = 0)"""
    rules = [
        ("unit_id", "positive", "unit_id > 0"),
        ("product_id", "matches_pattern", "regexp_matches(product_id, '^[LMH][0-9]{5}$')"),
        ("type", "in_set", "type IN ('L', 'M', 'H')"),
        *[(c, "in_range", t) for c, t in OK.items()],
        *[(c, "in_set", f"{c} IN (0, 1)") for c in [LABEL, *FAILURE_FLAGS]],
    ]
    failing = " UNION ALL ".join(
        [
            f"SELECT unit_id, '{c}' AS \"column\", 'not_null' AS \"check\", CAST({c} AS varchar) AS value FROM doubled WHERE {c} IS NULL"
            for c in dict.fromkeys(r[0] for r in rules)
        ]
        + [f"SELECT unit_id, '{c}', '{k}', CAST({c} AS varchar) FROM doubled WHERE NOT ({t})" for c, k, t in rules]
        + [
            "SELECT unit_id, 'unit_id', 'unique', CAST(unit_id AS varchar) FROM doubled "
            "WHERE unit_id IN (SELECT unit_id FROM doubled GROUP BY unit_id HAVING count(*) > 1)"
        ]
    )
    failures = doubled + f", failures AS ({failing})"
    log_rows = "unit_id % 53 <> 0 AND unit_id % 67 <> 0 AND unit_id % 59 <> 0 AND unit_id % 61 <> 0"
    log_cols = (
        "air_temperature_k, process_temperature_k, CAST(rotational_speed_rpm AS DOUBLE) AS rotational_speed_rpm, torque_nm, "
        "CAST(tool_wear_min AS DOUBLE) AS tool_wear_min, type, failure_probability AS prediction"
    )
    log_doubles = [*SENSORS, "prediction"]
    first = "row_number() OVER (PARTITION BY type ORDER BY tool_wear_min, unit_id)"
    pass_ctes = REQUESTS + """, passed AS (
      SELECT r.*, h.n FROM readings r JOIN heads h USING (request_id)
      WHERE request_id NOT IN (SELECT request_id FROM errors))"""
    version = """CASE WHEN day(ts) <= 10 OR (day(ts) <= 20 AND event_id % 2 = 0) THEN 'None' ELSE '1.1.0' END"""
    probes = f"""probes AS (SELECT event_id, ts, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, {version} AS api_version FROM events)"""
    series = "series AS (SELECT user_id AS series, ts, event_id, value / 100e0 AS value FROM events)"
    scan = values([(f"{t!r}::DOUBLE",) for t in SCAN])
    f2 = "CASE WHEN 5 * tp + 4 * fn + fp = 0 THEN 0e0 ELSE 5e0 * tp / (5 * tp + 4 * fn + fp) END AS f2_score"
    scanned = SCORED + f""", scan AS (
      SELECT *, {f2} FROM (SELECT threshold, {CELLS.format(t='threshold')} FROM scored, {scan} v(threshold) GROUP BY threshold))"""
    totals = SCORED + f", ranked AS ({ranking_sql('scored')})"
    le = [f"count(*) FILTER (duration_ms <= {b!r}) AS le{i}" for i, b in enumerate(LATENCY_BOUNDS)]
    interp = " ".join(
        f"WHEN le{i} >= q * total THEN {(LATENCY_BOUNDS[i - 1] if i else 0.0)!r} + {(b - (LATENCY_BOUNDS[i - 1] if i else 0.0))!r} "
        f"* (q * total - {f'le{i - 1}' if i else '0'}) / (le{i} - {f'le{i - 1}' if i else '0'})"
        for i, b in enumerate(LATENCY_BOUNDS)
    )
    summary_q = [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
    flags = unpivot("clean", FAILURE_FLAGS, "machine_failure AS label") + (
        " UNION ALL SELECT machine_failure AS label, 'any_flag', CAST(greatest(" + ", ".join(FAILURE_FLAGS) + ") AS DOUBLE) FROM clean"
    )
    out = {
        "read_raw": sql(TELEMETRY, f"SELECT {raw} FROM telemetry", ['"Air temperature [K]"', '"Process temperature [K]"', '"Torque [Nm]"']),
        "working_schema": sql(TELEMETRY, f"SELECT {working} FROM telemetry", reading),
        "null_tripwire": sql(TELEMETRY, " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM telemetry"
            for c in ["unit_id", "type", *SENSORS, LABEL])),
        "training_frame": sql(CLEAN, f"SELECT unit_id, type, {sensors}, machine_failure AS label FROM clean", reading),
        "prediction_log_flat": sql(TELEMETRY, f"SELECT {log_cols} FROM telemetry WHERE {log_rows}", log_doubles),
        "delivered_before": sql(CLEAN, """SELECT unit_id, false AS accepted FROM clean
            WHERE type IN ('L', 'M', 'H') AND unit_id % 3 <> 0 AND unit_id % 100 = 1"""),
        "appended_twice": sql(TELEMETRY, "SELECT type, count(*) AS rows, 2 AS batches FROM telemetry WHERE type IN ('L', 'M', 'H') GROUP BY 1"),
        "prediction_log_window": sql(
            TELEMETRY,
            f"SELECT {log_cols} FROM telemetry WHERE {log_rows} AND unit_id % 3 <> 0 AND date_trunc('second', ts) >= TIMESTAMP '2024-01-21'",
            log_doubles,
        ),
        "probe_log_parse": sql(probes, """SELECT concat(strftime(ts, '%H:%M:%S'), '.3N') AS clock, status,
            nullif(api_version, 'None') AS api_version FROM probes"""),
        "runs_by_batch": sql(RUNS, "SELECT * FROM runs WHERE batch_id = 'batch-0001'", RUN_DOUBLES),
        "drop_missing": sql(TELEMETRY, f"SELECT {cols} FROM telemetry WHERE torque_nm IS NOT NULL", [*reading, "failure_probability"]),
        "null_counts": sql(TELEMETRY, "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM telemetry" for c in REQUIRED_READING
        ) + ") WHERE nulls > 0"),
        "drop_bad_timestamps": sql(TELEMETRY, "SELECT unit_id, recorded_at FROM telemetry WHERE try_cast(recorded_at AS TIMESTAMP) IS NOT NULL"),
        "drop_outliers": sql(TELEMETRY, f"SELECT {cols} FROM telemetry WHERE " + " AND ".join(OK.values()), [*reading, "failure_probability"]),
        "outlier_counts": sql(TELEMETRY, " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({t}) AS rows FROM telemetry" for c, t in {**outside, "any": any_out}.items())),
        "clean_dataset": sql(CLEAN, f"SELECT {cols} FROM clean", [*reading, "failure_probability"]),
        "clean_report": sql(staged, " UNION ALL ".join(f"SELECT '{n}' AS item, {e} AS rows FROM staged" for n, e in items)),
        "quarantine": sql(TELEMETRY, f"""SELECT * FROM (
            SELECT unit_id, concat_ws(',', {', '.join(fault_reasons)}) AS reasons FROM telemetry) WHERE reasons <> ''"""),
        "request_contract": sql(REQUESTS, "SELECT * FROM errors"),
        "action_tier": sql(TELEMETRY, """SELECT unit_id, CASE WHEN failure_probability >= 6e-1 THEN 'urgent_alert'
            WHEN failure_probability >= 27e-2 THEN 'schedule_service' ELSE 'monitor' END AS action FROM telemetry"""),
        "action_mix": sql(TELEMETRY, """SELECT CASE WHEN failure_probability >= 6e-1 THEN 'urgent_alert'
            WHEN failure_probability >= 27e-2 THEN 'schedule_service' ELSE 'monitor' END AS action, count(*) AS rows
            FROM telemetry GROUP BY 1"""),
        "contract_failures": sql(failures, "SELECT * FROM failures"),
        "duplicate_ids": sql(doubled, "SELECT unit_id FROM doubled WHERE unit_id IN (SELECT unit_id FROM doubled GROUP BY 1 HAVING count(*) > 1)"),
        "failures_by_check": sql(failures, 'SELECT "column", "check", count(*) AS failures FROM failures GROUP BY 1, 2'),
        "failure_sample": sql(failures, 'SELECT * FROM failures ORDER BY unit_id, "column", "check" LIMIT 10'),
        "numeric_profile": sql(CLEAN, f"""SELECT "column", count(*) AS rows, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
            max(value) AS max, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75
            FROM ({unpivot('clean', SENSORS)}) GROUP BY 1""", ["mean", "std", "min", "max", "p25", "p50", "p75"]),
        "type_counts": sql(CLEAN, "SELECT type AS value, count(*) AS rows FROM clean GROUP BY 1"),
        "label_balance": sql(CLEAN, """SELECT machine_failure AS label, count(*) AS rows,
            count(*) * 1e0 / (SELECT count(*) FROM clean) AS share FROM clean GROUP BY 1""", ["share"]),
        "missingness": sql(TELEMETRY, " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM telemetry" for c in WORKING)),
        "rolling_mean": rolling_sql(("rollmean",)),
        "rolling_std": rolling_sql(("rollstd",)),
        "rate_of_change": rolling_sql(("roc",)),
        "rolling_features": rolling_sql(),
        "rolling_features_blocked": rolling_sql(),
        "rolling_by_vehicle": sql(CLEAN, f"SELECT vehicle_id, unit_id, {rolling_exprs('vehicle_id', 'ts, unit_id', (5, 10))} FROM clean", names((5, 10))),
        "stream_prefix": sql(CLEAN, f"""SELECT * FROM (SELECT unit_id, type, {sensors}, CAST({first} AS INT) AS position FROM clean)
            WHERE position <= 37""", reading),
        "request_features": sql(pass_ctes, f"""SELECT request_id, concat('veh-', request_id) AS vehicle_id, head_type AS type,
            CAST(n AS INT) AS readings_used, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in SENSORS)}, {', '.join(names())}
            FROM (SELECT *, first_value(type) OVER (PARTITION BY request_id ORDER BY unit_id) AS head_type,
                  {rolling_exprs('request_id', 'unit_id')} FROM passed) WHERE i = n - 1""", [*SENSORS, *names()]),
        "feature_parity": sql(CLEAN, f"""SELECT type, unit_id, 25 AS features_checked, 0 AS mismatches
            FROM (SELECT type, unit_id, {first} AS position, count(*) OVER (PARTITION BY type) AS n FROM clean) WHERE position = least(37, n)"""),
        "cold_start_skew": sql(CLEAN, f"""SELECT type, CAST(position AS INT) AS position, unit_id, 25 AS features, {' + '.join(
            f"CAST(abs({n} - {n.split('_rollmean_w')[0] if '_rollmean_w' in n else '0'}) > 1e-9 AS INT)" for n in names())} AS diverged
            FROM (SELECT *, {first} AS position, {rolling_exprs('type', 'tool_wear_min, unit_id')} FROM clean) WHERE position <= 5"""),
        "boundary_leak": sql(CLEAN, f"""SELECT type, unit_id, keyed_mean, unkeyed_mean, unkeyed_mean - keyed_mean AS leak FROM (
            SELECT type, unit_id, {first} AS position,
              avg(torque_nm) OVER (PARTITION BY type ORDER BY tool_wear_min, unit_id ROWS 4 PRECEDING) AS keyed_mean,
              avg(torque_nm) OVER (ORDER BY type, tool_wear_min, unit_id ROWS 4 PRECEDING) AS unkeyed_mean FROM clean)
            WHERE position <= 4""", ["keyed_mean", "unkeyed_mean", "leak"]),
        "leaderboard": sql(RUNS, """SELECT batch_id, run_id, val_expected_cost_per_1000,
            CAST(row_number() OVER (PARTITION BY batch_id ORDER BY val_expected_cost_per_1000, seq) AS INT) AS rank FROM runs""",
            ["val_expected_cost_per_1000"]),
        "select_best": sql(RUNS, """SELECT batch_id, run_id, seq, val_recall, val_pr_auc, val_expected_cost_per_1000,
            coalesce(val_recall, 0) >= 5e-1 AS passes_gate FROM best""", ["val_recall", "val_pr_auc", "val_expected_cost_per_1000"]),
        "runner_up": sql(RUNS, """SELECT batch_id, b.run_id AS best_id, b.val_expected_cost_per_1000 AS best_cost, t.run_id AS runner_up_id,
            t.val_pr_auc AS runner_up_pr_auc, t.val_expected_cost_per_1000 AS runner_up_cost,
            t.val_expected_cost_per_1000 - b.val_expected_cost_per_1000 AS cost_gap
            FROM best b JOIN (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY coalesce(val_pr_auc, 0) DESC, seq) AS r FROM runs) t
            USING (batch_id) WHERE t.r = 1""", ["best_cost", "runner_up_pr_auc", "runner_up_cost", "cost_gap"]),
        "gate_stats": sql(RUNS, """SELECT batch_id, count(*) AS runs, count(*) FILTER (coalesce(val_recall, 0) >= 5e-1) AS passing
            FROM runs GROUP BY 1"""),
        "champion_challenger": sql(HISTORY, "SELECT * FROM history", ["candidate_recall", "candidate_cost_per_1000", "champion_cost_per_1000"]),
        "alias_events": sql(HISTORY, "SELECT * FROM aliases"),
        "champion": sql(HISTORY, """SELECT a.alias, a.version, h.candidate_run_id AS run_id,
            h.candidate_cost_per_1000 AS val_expected_cost_per_1000
            FROM aliases a JOIN history h ON h.candidate_version = a.version
            WHERE a.alias = 'production' ORDER BY a.seq DESC LIMIT 1""", ["val_expected_cost_per_1000"]),
        "log_reconcile": """SELECT concat('veh-', event_id) AS marker,
            CASE WHEN event_id % 13 = 0 THEN 'missing_in_right' ELSE 'missing_in_left' END AS status
            FROM events WHERE (event_id % 13 = 0) <> (event_id % 17 = 0)""",
        "what_if": sql(CLEAN, """SELECT unit_id, 5e-1 * torque_nm / 150e0 + 5e-1 * tool_wear_min / 400e0 AS score_baseline,
            5e-1 * least(torque_nm + 20e0, 150e0) / 150e0 + 5e-1 * least(tool_wear_min + 100, 400) / 400e0 AS score_escalated
            FROM clean""", ["score_baseline", "score_escalated"]),
        "reference_sample": sql(CLEAN, f"""SELECT unit_id, type, {sensors} FROM clean
            ORDER BY {hash_sql(13)}, unit_id LIMIT 2000""", reading),
        "stratified_split": sql(SPLIT, "SELECT * FROM split"),
        "stratified_folds": sql(SPLIT, "SELECT unit_id, type, label, CAST(pos % 5 AS INT) AS fold FROM ranked"),
        "split_report": sql(SPLIT, "SELECT split, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM split GROUP BY 1"),
        "split_audit": sql(SCORED, f"""SELECT *, {AUDIT} FROM (
            SELECT concat(vehicle_id, '/', unit_id % 5) AS split, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives
            FROM scored GROUP BY 1)"""),
        "class_weights": sql(SCORED, """SELECT label, count(*) AS rows,
            (SELECT count(*) * 1e0 / count(DISTINCT label) FROM scored) / count(*) AS weight FROM scored GROUP BY 1""", ["weight"]),
        "confusion": sql(SCORED, f"SELECT {CELLS.format(t='27e-2')} FROM scored"),
        "threshold_scan": sql(scanned, "SELECT * FROM scan", ["threshold", "f2_score"]),
        "best_threshold": sql(scanned, "SELECT threshold, f2_score FROM scan ORDER BY f2_score DESC, threshold LIMIT 1", ["threshold", "f2_score"]),
        "classification_report": report_sql(doubles=[*RATE_NAMES, "threshold", "brier_score"]),
        "average_precision": sql(totals, "SELECT pr_auc, reason FROM ranked", ["pr_auc"]),
        "roc_auc": sql(totals, "SELECT roc_auc, reason FROM ranked", ["roc_auc"]),
        "isotonic_fit": sql(CLEAN + """, g AS (
            SELECT tool_wear_min AS x, count(*) AS n, sum(machine_failure) AS f FROM clean WHERE machine_failure IS NOT NULL GROUP BY 1
            ), c AS (SELECT x, n, f, sum(n) OVER (ORDER BY x) AS cn, sum(f) OVER (ORDER BY x) AS cf FROM g
            ), m AS (SELECT s.x AS s, t.x AS t, t.n, (t.cf - s.cf + s.f) * 1e0 / (t.cn - s.cn + s.n) AS mean FROM c s JOIN c t ON t.x >= s.x
            ), w AS (SELECT t, n, min(mean) OVER (PARTITION BY s ORDER BY t DESC) AS least FROM m)""",
            "SELECT t AS tool_wear_min, any_value(n) AS rows, max(least) AS value FROM w GROUP BY 1", ["value"]),
        "brier": sql(SCORED, "SELECT avg((score - label) * (score - label)) AS brier_score FROM scored", ["brier_score"]),
        "expected_cost": report_sql("threshold, expected_cost_per_1000", doubles=["threshold", "expected_cost_per_1000"]),
        "error_rates": report_sql("fn_rate, fp_rate, n_samples, n_positive", doubles=["fn_rate", "fp_rate"]),
        "report_by_type": report_sql(by="type", doubles=[*RATE_NAMES, "threshold", "brier_score"]),
        "drift_wasserstein": sql(drift_ctes(), 'SELECT "column", wasserstein, ref_rows, cur_rows FROM num', ["wasserstein"]),
        "drift_ks": sql(drift_ctes(), """SELECT "column", ks, CASE WHEN lam < 2e-1 THEN 1e0 ELSE greatest(0e0, least(1e0,
            list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 2e0 ELSE -2e0 END * exp(-2e0 * k * k * lam * lam))))) END AS ks_p
            FROM (SELECT *, ks * sqrt(ref_rows * 1e0 * cur_rows / (ref_rows + cur_rows)) AS lam FROM num)""", ["ks", "ks_p"]),
        "drift_js": sql(drift_ctes(), 'SELECT "column", js, ref_rows, cur_rows FROM cat', ["js"]),
        "drift_psi": sql(drift_ctes(), f"""SELECT "column", sum((p - q) * ln(p / q)) AS psi FROM (
            SELECT "column", greatest(sum(r) * 1e0 / max(nr), 1e-4) AS p, greatest(sum(c) * 1e0 / max(nc), 1e-4) AS q FROM (
              SELECT l."column", r, c, sum(r) OVER (PARTITION BY l."column") AS nr, sum(c) OVER (PARTITION BY l."column") AS nc,
                     len(list_filter(list_distinct(edges), lambda e: e < value)) AS bin
              FROM long l JOIN (SELECT "column", quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
                                FROM ({unpivot('ref', NUMERIC, 'w')}) GROUP BY 1) e ON e."column" = l."column")
            GROUP BY "column", bin) GROUP BY 1""", ["psi"]),
        "drift_by_column": sql(drift_ctes(), "SELECT * EXCLUDE (w) FROM by_column", ["score"]),
        "drift_summary": sql(drift_ctes(), "SELECT * EXCLUDE (w) FROM summary", SUMMARY),
        "drift_cold_columns": sql(drift_ctes(cold=True), "SELECT * EXCLUDE (w) FROM by_column", ["score"]),
        "drift_cold_summary": sql(drift_ctes(cold=True), "SELECT * EXCLUDE (w) FROM summary", SUMMARY),
        "drift_by_window": sql(drift_ctes(windows=[360, 1440, 7200]), "SELECT * EXCLUDE (w), w AS window_minutes FROM summary", SUMMARY),
        "cold_shift": sql(CLEAN, "SELECT unit_id, " + ", ".join(f"{e} AS {c}" for c, e in COLD_EXPR.items()) + " FROM clean", list(COLD_EXPR)),
        "latency_quantiles": sql(
            REQUEST_LOG + ", p AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, duration_ms FROM reqlog WHERE path = '/predict')",
            quantile_sql("p", "duration_ms", [0.5, 0.95], "window_start"), ["quantile", "q"], ["window_start"]),
        "latency_histogram_quantiles": sql(REQUEST_LOG, f"""SELECT window_start, q, CASE {interp} ELSE {LATENCY_BOUNDS[-1]!r} END AS quantile FROM (
            SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, {', '.join(le)}, count(*) AS total FROM reqlog
            WHERE path = '/predict' GROUP BY 1), (VALUES (5e-1), (95e-2)) v(q)""", ["q", "quantile"], ["window_start"]),
        "throughput": sql(REQUEST_LOG, """SELECT date_trunc('minute', ts) AS window_start, path, count(*) AS requests,
            count(*) / 60e0 AS per_second FROM reqlog GROUP BY 1, 2""", ["per_second"], ["window_start"]),
        "error_rate": sql(REQUEST_LOG, """SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, count(*) AS requests,
            count(*) FILTER (status_code >= 500) AS errors, count(*) FILTER (status_code >= 500) * 1e0 / count(*) AS error_rate
            FROM reqlog GROUP BY 1""", ["error_rate"], ["window_start"]),
        "error_rate_sliding": sql(REQUEST_LOG, """SELECT window_start, count(*) AS requests, count(*) FILTER (status_code >= 500) AS errors,
            count(*) FILTER (status_code >= 500) * 1e0 / count(*) AS error_rate FROM (
            SELECT *, date_trunc('minute', ts) - to_minutes(i) AS window_start FROM reqlog, range(0, 5) r(i)) GROUP BY 1""",
            ["error_rate"], ["window_start"]),
        "status_mix": sql(REQUEST_LOG, """SELECT date_trunc('minute', ts) AS window_start, concat(status_code // 100, 'xx') AS status,
            count(*) AS requests FROM reqlog GROUP BY 1, 2""", (), ["window_start"]),
        "latest_metric": sql(series, """SELECT series, ts, value FROM (
            SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts DESC, event_id DESC) AS r FROM series) WHERE r = 1""", ["value"], ["ts"]),
        "alert_state": sql(series, """SELECT a.series, v.value, CASE WHEN v.value IS NULL THEN 'NoData' WHEN v.value >= 3e-1 THEN 'ALERT' ELSE 'OK' END AS state
            FROM (SELECT DISTINCT series FROM series) a LEFT JOIN (
              SELECT series, value, row_number() OVER (PARTITION BY series ORDER BY ts DESC, event_id DESC) AS r FROM series
              WHERE ts > TIMESTAMP '2024-01-30' AND ts <= TIMESTAMP '2024-01-31') v ON v.series = a.series AND v.r = 1""", ["value"]),
        "alert_state_daily": sql(series, """SELECT a.series, v.value, CASE WHEN v.value IS NULL THEN 'NoData' WHEN v.value >= 3e-1 THEN 'ALERT' ELSE 'OK' END AS state
            FROM (SELECT DISTINCT series FROM series) a LEFT JOIN (
              SELECT series, value, row_number() OVER (PARTITION BY series ORDER BY ts DESC, event_id DESC) AS r FROM series
              WHERE ts > TIMESTAMP '2024-01-30 23:50:00' AND ts <= TIMESTAMP '2024-01-31') v ON v.series = a.series AND v.r = 1""", ["value"]),
        "series_gaps": sql(series, """SELECT *, gap_seconds <= 300 AS hidden FROM (
            SELECT series, prev_ts, ts, event_id, (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 AS gap_seconds FROM (
              SELECT *, lag(ts) OVER (PARTITION BY series ORDER BY ts, event_id) AS prev_ts FROM series))
            WHERE gap_seconds > 15""", ["gap_seconds"], ["prev_ts", "ts"]),
        "asof_fill": sql(series, """SELECT series, make_timestamp(step * 60000000) AS step_ts, ts AS sample_ts, value FROM (
            SELECT *, unnest(range(CAST(ceil(epoch_us(ts) / 6e7) AS BIGINT),
                     least(epoch_us(ts) + 300000000, coalesce(epoch_us(nxt) - 1, epoch_us(ts) + 300000000)) // 60000000 + 1)) AS step
            FROM (SELECT *, lead(ts) OVER (PARTITION BY series ORDER BY ts, event_id) AS nxt FROM series))""",
            ["value"], ["step_ts", "sample_ts"]),
        "rejection_rate": sql(REQUESTS, """SELECT date_trunc('hour', h.ts) AS window_start, e.error_type, count(DISTINCT h.request_id) AS rejected,
            any_value(a.requests) AS requests, count(DISTINCT h.request_id) * 1e0 / any_value(a.requests) AS rate
            FROM errors e JOIN heads h USING (request_id)
            JOIN (SELECT date_trunc('hour', ts) AS hr, count(*) AS requests FROM heads GROUP BY 1) a ON a.hr = date_trunc('hour', h.ts)
            GROUP BY 1, 2""", ["rate"], ["window_start"]),
        "latency_summary": sql(REQUEST_LOG + """, s AS (SELECT count(*) * 1e0 AS requests,
              (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS total_seconds, max(duration_ms) AS slowest, min(duration_ms) AS fastest,
              avg(duration_ms) AS average FROM reqlog)""",
            "SELECT 'requests' AS item, requests AS value FROM s " + " ".join(
                f"UNION ALL SELECT '{c}', {c} FROM s" for c in ["total_seconds", "slowest", "fastest", "average"])
            + " UNION ALL SELECT 'requests_per_second', requests / total_seconds FROM s " + " ".join(
                f"UNION ALL SELECT 'p{round(q * 100)}', quantile_cont(duration_ms, {q!r}) FROM reqlog" for q in summary_q), ["value"]),
        "latency_histogram": sql(REQUEST_LOG + ", s AS (SELECT min(duration_ms) AS lo, max(duration_ms) AS hi FROM reqlog)",
            """, e AS (SELECT i, CASE WHEN i = 10 THEN hi ELSE lo + (hi - lo) * (i / 10e0) END AS upper,
                 CASE WHEN i = 0 THEN lo - 1e0 ELSE lo + (hi - lo) * ((i - 1) / 10e0) END AS lower FROM s, range(0, 11) r(i))
            SELECT CAST(i AS INT) AS bin, upper, (SELECT count(*) FROM reqlog WHERE duration_ms > e.lower AND duration_ms <= e.upper) AS requests FROM e""",
            ["upper"]),
        "version_timeline": sql(probes, """SELECT *, greatest(0e0, coalesce((epoch_us(lag(last_seen) OVER (ORDER BY first_seen, api_version))
            - epoch_us(first_seen)) / 1e6, 0e0)) AS overlap_seconds FROM (
            SELECT api_version, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS probes, count(*) FILTER (status <> 200) AS failures
            FROM probes GROUP BY 1)""", ["overlap_seconds"], ["first_seen", "last_seen"]),
        "version_changes": sql(probes, """SELECT event_id, ts, from_version, api_version AS to_version FROM (
            SELECT *, lag(api_version) OVER (ORDER BY ts, event_id) AS from_version FROM probes) WHERE from_version <> api_version""", (), ["ts"]),
        "leak_audit": sql(CLEAN + f""", flags AS ({flags.replace('AS value', 'AS score')})""", f"""
            SELECT a."column", agreement, roc_auc, pr_auc FROM (
              SELECT "column", avg(CAST(score = label AS INT)) AS agreement FROM flags GROUP BY 1) a
            JOIN ({ranking_sql('flags', '"column"')}) r ON a."column" = r."column" """, ["agreement", "roc_auc", "pr_auc"]),
        "bad_input_audit": sql(TELEMETRY, """SELECT count(*) AS rows, count(*) FILTER (type = 'X') AS unseen_category,
            count(*) FILTER (torque_nm IS NULL) AS missing_sensor, avg(CAST(type = 'X' OR torque_nm IS NULL AS INT)) AS bad_share
            FROM telemetry""", ["bad_share"]),
    }
    vehicle = sql(
        CLEAN, f"SELECT vehicle_id, unit_id, {rolling_exprs('vehicle_id', 'ts, unit_id')} FROM clean", names())
    out |= {
        "stream_rolling_features": rolling_sql(),
        "prediction_log_daily": out["prediction_log_window"],
        "stream_vehicle_features": vehicle,
        "stream_reordered_features": vehicle,
        "stream_reconcile": out["log_reconcile"],
        "stream_late_rows": sql(CLEAN, """SELECT vehicle_id, unit_id FROM clean c WHERE unit_id % 29 = 0 AND EXISTS (
            SELECT 1 FROM clean e WHERE e.vehicle_id = c.vehicle_id AND e.unit_id % 29 <> 0
              AND (e.ts > c.ts OR (e.ts = c.ts AND e.unit_id > c.unit_id)))"""),
        "stream_rejections": out["request_contract"],
        "stream_status_mix": out["status_mix"],
        "stream_throughput": out["throughput"],
        "stream_error_rate": out["error_rate"],
        "stream_latency_quantiles": out["latency_histogram_quantiles"],
        "stream_drift": out["drift_summary"],
        "stream_reading_scores": sql(CLEAN, "SELECT type, count(*) AS rows, count(*) AS probabilities FROM clean GROUP BY 1"),
        "stream_request_scores": f"""SELECT '1' AS model_version, count(*) AS rows, CAST(sum(readings_used) AS BIGINT) AS readings,
            count(*) AS probabilities FROM ({out['request_features']})""",
        "log_to_drift": f"""SELECT type, count(*) AS rows, {', '.join(f'round(avg({c}), 6) + 0e0 AS {c}' for c in SENSORS)}
            FROM ({out['request_features']}) GROUP BY 1""",
    }
    kinds = sql(SPLIT, """SELECT kind, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, true AS as_it_should
        FROM split, (VALUES ('uncalibrated'), ('calibrated')) k(kind) WHERE split = 'test' GROUP BY 1""")
    held = "FROM split WHERE split <> 'train'"
    runs = values([(str(i), f"'{n}'", str(k)) for i, (n, k) in enumerate(EXPERIMENTS)])
    out |= {
        # the raw layout has no timestamp to be bad
        "validated_dataset": sql(TELEMETRY, f"""SELECT unit_id, type, {', '.join(SENSORS)}, machine_failure FROM telemetry
            WHERE torque_nm IS NOT NULL AND type IN ('L', 'M', 'H') AND {" AND ".join(OK.values())}""", SENSORS),
        "registry_roundtrip": sql(CLEAN, """SELECT 'staging' AS alias, 1 AS version, count(*) AS rows, count(*) AS probabilities,
            true AS threshold_valid FROM clean"""),
        "rf_scores": sql(SPLIT, f"SELECT split, count(*) AS rows, count(*) AS probabilities, count(*) AS tiers {held} GROUP BY 1"),
        "cv_pr_auc": sql(SPLIT, """SELECT CAST(pos % 5 AS INT) AS fold, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives,
            true AS better_than_chance FROM ranked GROUP BY 1 UNION ALL SELECT -1, count(DISTINCT pos % 5), NULL, true FROM ranked"""),
        "calibrated_scores": kinds,
        "isotonic_scores": kinds,
        "experiment_grid": sql(SPLIT, f"""SELECT CAST(seq AS INT) AS seq, concat('grid-', lpad(CAST(seq AS VARCHAR), 2, '0')) AS run_id, name,
            CAST(n AS INT) AS n_numeric, (SELECT count(*) FROM split WHERE split = 'validation') AS val_rows,
            (SELECT count(*) FROM split WHERE split = 'test') AS test_rows,
            (SELECT CAST(sum(label) AS BIGINT) FROM split WHERE split = 'validation') AS val_positives,
            true AS shares_valid, true AS threshold_valid FROM {runs} r(seq, name, n)"""),
        "risk_direction": sql(CLEAN, "SELECT count(*) AS rows, count(*) AS probabilities FROM clean"),
        "drift_reference_window": sql(CLEAN, "SELECT type, count(*) AS rows, count(*) AS probabilities FROM clean GROUP BY 1"),
    }
    return out
