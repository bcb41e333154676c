"""DuckDB SQL oracles, one per registered query (same column names as the Spark side).

All share one CTE prefix: the fixture binding of ``events`` to requests / delivery /
verification and the Silver join. Rates are DOUBLE; integer sums are cast to BIGINT.
"""

from __future__ import annotations

import math

BINDING = r"""
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INT) AS k,
         CASE WHEN event_type = 'error' THEN 'ait'
              WHEN event_type = 'signup' AND user_id % 10 = 7 THEN 'risky'
              WHEN event_type = 'purchase' AND user_id % 10 = 8 THEN 'dead'
              ELSE 'normal' END AS scen
  FROM events),
req0 AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id,
    CASE scen WHEN 'ait' THEN concat('550199', lpad(CAST(k AS VARCHAR), 4, '0'))
              WHEN 'dead' THEN concat('447700', lpad(CAST(k AS VARCHAR), 4, '0'))
              ELSE concat(CAST(100000 + (user_id * 7919) % 900000 AS VARCHAR),
                          lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0')) END AS msisdn,
    CASE scen WHEN 'ait' THEN 'ent_3' ELSE concat('ent_', CAST(1 + user_id % 10 AS VARCHAR)) END
      AS enterprise_id,
    CASE WHEN scen = 'ait' THEN 'LV' WHEN scen = 'risky' THEN 'XS' WHEN user_id % 4 = 0 THEN 'US'
         WHEN user_id % 4 = 1 THEN 'IN' WHEN user_id % 4 = 2 THEN 'GB' ELSE 'BR' END AS country_iso,
    CASE WHEN scen = 'ait' THEN '247' WHEN scen = 'risky' THEN '881' WHEN user_id % 4 = 0 THEN '310'
         WHEN user_id % 4 = 1 THEN '404' WHEN user_id % 4 = 2 THEN '234' ELSE '724' END AS mcc,
    CASE WHEN scen = 'ait' THEN '1' WHEN scen = 'risky' THEN '0' WHEN user_id % 4 = 0 THEN '260'
         WHEN user_id % 4 = 1 THEN '45' WHEN user_id % 4 = 2 THEN '10' ELSE '5' END AS mnc,
    concat('10.0.', CAST(user_id % 256 AS VARCHAR), '.', CAST(k AS VARCHAR)) AS ip,
    CASE event_type WHEN 'click' THEN 'voice' WHEN 'view' THEN 'whatsapp' ELSE 'sms' END AS channel,
    ts AS event_ts, event_id
  FROM e),
requests_raw AS (SELECT * FROM req0 UNION ALL SELECT * FROM req0 WHERE event_id % 50 = 0),
requests AS (SELECT DISTINCT * EXCLUDE (event_id) FROM requests_raw),
delivery AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id,
    CASE WHEN k % 20 = 0 THEN 'failed' ELSE 'delivered' END AS status,
    CAST(50 + CAST(round(value * 100) AS BIGINT) % 3951 AS INT) AS operator_latency_ms,
    ts + CAST(50 + CAST(round(value * 100) AS BIGINT) % 3951 AS INT) * INTERVAL 1 MILLISECOND
      AS delivery_ts
  FROM e WHERE k <> 50),
verification AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id,
    CASE WHEN scen = 'ait' THEN (CASE WHEN k % 20 = 1 THEN 'verified' ELSE 'timeout' END)
         WHEN scen = 'dead' THEN 'timeout' WHEN k % 10 < 7 THEN 'verified' ELSE 'timeout' END
      AS outcome,
    CAST(1 + k % 3 AS INT) AS attempts,
    ts + CAST(50 + CAST(round(value * 100) AS BIGINT) % 3951 AS INT) * INTERVAL 1 MILLISECOND
       + k * INTERVAL 1 SECOND AS verification_ts
  FROM e WHERE k % 20 <> 0 AND k <> 50),
silver AS (
  SELECT r.*, d.status AS delivery_status, d.operator_latency_ms, d.delivery_ts,
    v.outcome AS verification_outcome, v.attempts, v.verification_ts,
    substr(r.msisdn, 1, 6) AS number_range, coalesce(v.outcome = 'verified', false) AS is_verified
  FROM requests r LEFT JOIN delivery d ON r.request_id = d.request_id
                  LEFT JOIN verification v ON r.request_id = v.request_id),
funnel AS (
  SELECT enterprise_id, mcc, mnc, count(*) AS requested,
    count_if(delivery_status = 'delivered') AS delivered,
    count_if(is_verified) AS verified,
    round(CAST(count_if(is_verified) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0.0), 4)
      AS verify_rate
  FROM silver GROUP BY 1, 2, 3),
loss AS (
  SELECT enterprise_id, mcc, mnc, requested, verify_rate,
    CASE WHEN requested > 100 AND verify_rate < 0.10::DOUBLE
         THEN CAST(requested AS DOUBLE) * 0.03::DOUBLE ELSE 0.0::DOUBLE END
      AS estimated_ait_loss_usd
  FROM funnel)
"""


def _score_sql(req: str = "requests", ver: str = "verifications", mx: str = "msisdn_max_count",
               ait_min: int = 100) -> dict[str, str]:
    """The four rule terms, score and severity as DuckDB expressions (DOUBLE arithmetic)."""
    r = f"coalesce(CAST({req} AS BIGINT), 0)"
    v = f"coalesce(CAST({ver} AS BIGINT), 0)" if ver else "CAST(0 AS BIGINT)"
    m = f"coalesce(CAST({mx} AS BIGINT), 0)" if mx else "CAST(0 AS BIGINT)"
    rate = f"(CASE WHEN {r} <> 0 THEN CAST({v} AS DOUBLE) / CAST({r} AS DOUBLE) ELSE 0.0::DOUBLE END)"
    velocity = (f"(CASE WHEN {m} - 30 > 0 THEN CAST(least({m} - 30, 100) AS DOUBLE) * 0.5::DOUBLE "
                f"ELSE 0.0::DOUBLE END)")
    ait = (f"(CASE WHEN {r} < {ait_min} THEN 0.0::DOUBLE WHEN {rate} >= 0.10::DOUBLE THEN 0.0::DOUBLE "
           f"ELSE (0.10::DOUBLE - {rate}) / 0.10::DOUBLE * CAST({r} AS DOUBLE) * 2.0::DOUBLE END)")
    never = f"(CASE WHEN {r} >= 50 AND {v} = 0 THEN 40.0::DOUBLE ELSE 0.0::DOUBLE END)"
    route = ("(CASE WHEN coalesce((mcc = '247' AND mnc = '1') OR (mcc = '88' AND mnc = '0') "
             "OR (mcc = '881' AND mnc = '0'), false) THEN 25.0::DOUBLE ELSE 0.0::DOUBLE END)")
    score = f"({velocity} + {ait} + {never} + {route})"
    sev = (f"(CASE WHEN {score} >= 100.0 THEN 'high' WHEN {score} >= 20.0 THEN 'medium' "
           f"ELSE 'low' END)")
    return dict(velocity=velocity, ait=ait, never=never, route=route, score=score, severity=sev)


# Scored aggregate over Silver: two-level msisdn maximum and distinct IPs.
_AGG_SILVER = """
agg AS (
  SELECT t.enterprise_id, t.number_range, t.mcc, t.mnc, t.requests, t.verifications,
         t.msisdn_max_count, i.distinct_ip
  FROM (SELECT enterprise_id, number_range, mcc, mnc, CAST(sum(n) AS BIGINT) AS requests,
               CAST(sum(v) AS BIGINT) AS verifications, max(n) AS msisdn_max_count
        FROM (SELECT enterprise_id, number_range, mcc, mnc, msisdn, count(*) AS n,
                     sum(CAST(is_verified AS BIGINT)) AS v
              FROM silver GROUP BY ALL) GROUP BY ALL) t
  JOIN (SELECT enterprise_id, number_range, mcc, mnc, count(DISTINCT ip) AS distinct_ip
        FROM silver GROUP BY ALL) i
  ON t.enterprise_id IS NOT DISTINCT FROM i.enterprise_id
     AND t.number_range IS NOT DISTINCT FROM i.number_range
     AND t.mcc IS NOT DISTINCT FROM i.mcc AND t.mnc IS NOT DISTINCT FROM i.mnc)
"""

_S = _score_sql()
_SCORED = f"""
scored AS (
  SELECT *, {_S['velocity']} AS velocity_points, {_S['ait']} AS ait_signature_points,
         {_S['never']} AS never_verified_points, {_S['route']} AS risky_route_points,
         {_S['score']} AS score, {_S['severity']} AS severity
  FROM agg)
"""

_D = _score_sql(ait_min=50)
_DAILY = f"""
dagg AS (
  SELECT t.window_start, t.window_end, t.enterprise_id, t.number_range, t.mcc, t.mnc,
         t.requests, t.verifications, t.msisdn_max_count, i.distinct_ip
  FROM (SELECT window_start, window_end, enterprise_id, number_range, mcc, mnc,
               CAST(sum(n) AS BIGINT) AS requests, CAST(sum(v) AS BIGINT) AS verifications,
               max(n) AS msisdn_max_count
        FROM (SELECT date_trunc('day', event_ts) AS window_start,
                     date_trunc('day', event_ts) + INTERVAL 1 DAY AS window_end,
                     enterprise_id, number_range, mcc, mnc, msisdn, count(*) AS n,
                     sum(CAST(is_verified AS BIGINT)) AS v
              FROM silver WHERE event_ts IS NOT NULL GROUP BY ALL) GROUP BY ALL) t
  JOIN (SELECT date_trunc('day', event_ts) AS window_start, enterprise_id, number_range, mcc, mnc,
               count(DISTINCT ip) AS distinct_ip
        FROM silver WHERE event_ts IS NOT NULL GROUP BY ALL) i
  ON t.window_start = i.window_start
     AND t.enterprise_id IS NOT DISTINCT FROM i.enterprise_id
     AND t.number_range IS NOT DISTINCT FROM i.number_range
     AND t.mcc IS NOT DISTINCT FROM i.mcc AND t.mnc IS NOT DISTINCT FROM i.mnc),
dscored AS (SELECT *, {_D['score']} AS score, {_D['severity']} AS severity FROM dagg),
dalerts AS (SELECT *, window_start AS created_at FROM dscored WHERE severity <> 'low')
"""


def _with(*ctes: str) -> str:
    extra = "".join("," + c for c in ctes)
    return BINDING + extra


def _disc_pct(value_expr: str, dims: list[str], ps: list[float], names: list[str],
              src: str = "silver") -> str:
    """Exact discrete percentile: smallest value whose running count >= p * total."""
    d = ", ".join(dims)
    picks = ", ".join(f"min(CASE WHEN cum >= {p}::DOUBLE * tot THEN val END) AS {n}"
                      for p, n in zip(ps, names))
    return f"""
SELECT {d}, {picks}
FROM (SELECT {d}, val, sum(cnt) OVER (PARTITION BY {d} ORDER BY val
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             sum(cnt) OVER (PARTITION BY {d}) AS tot
      FROM (SELECT {d}, {value_expr} AS val, count(*) AS cnt FROM {src}
            WHERE {value_expr} IS NOT NULL GROUP BY ALL))
GROUP BY {d}
"""


def _forest_sql(keys: tuple[str, ...], trees: int = 100, psi: int = 256, contamination: float = 0.1,
                seed: int = 42, fitted: str = "true", scored: str = "true") -> str:
    """The isolation forest in SQL: sample, trees level by level, paths, scores (CTE ``judged``)."""
    key, cols = ", ".join(keys), ("requests", "verify_rate", "avg_latency", "range_spread")
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)

    def features(where: str) -> str:
        return f"""SELECT {key}, count(*) AS requests, avg(CAST(is_verified AS DOUBLE)) AS verify_rate,
       avg(CAST(operator_latency_ms AS DOUBLE)) AS avg_latency, count(DISTINCT number_range) AS range_spread
FROM silver WHERE {present} AND ({where}) GROUP BY {key}"""

    def drawn(*parts: str) -> str:
        text = " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
        return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT)"

    def c(n: str) -> str:
        return (f"CASE WHEN {n} = 2 THEN 1.0 WHEN {n} > 2 THEN 2.0 * (ln({n} - 1.0) + 0.5772156649015329) "
                f"- 2.0 * ({n} - 1.0) / {n} ELSE 0.0 END")
    filled = ", ".join(f"coalesce(CAST({x} AS DOUBLE), m_{x})" for x in cols)
    means = ", ".join(f"coalesce(round(avg(CAST({x} AS DOUBLE)), 12), 0.0) AS m_{x}" for x in cols)
    lows = ", ".join(f"min(x[{i}]) OVER nd" for i in range(1, 5))
    highs = ", ".join(f"max(x[{i}]) OVER nd" for i in range(1, 5))
    ctes = [f"train AS MATERIALIZED ({features(fitted)})", f"apply AS MATERIALIZED ({features(scored)})",
            f"means AS (SELECT {means} FROM train)",
            "size AS (SELECT count(*) AS n, least(count(*), %d) AS psi, "
            "CAST(ceil(log2(greatest(least(count(*), %d), 2))) AS INT) AS depth FROM train)" % (psi, psi),
            f"""l0 AS MATERIALIZED (SELECT tree, x, CAST(1 AS BIGINT) AS node, n AS _n FROM (
  SELECT tree, [{filled}] AS x, size.n, size.psi,
         row_number() OVER (PARTITION BY tree ORDER BY {drawn(str(seed), "tree", *keys)}, {key}) AS rn
  FROM train, means, size, (SELECT unnest(range({trees})) AS tree)) WHERE rn <= psi)"""]
    parts = []
    for d in range(math.ceil(math.log2(max(psi, 2))) + 1):
        ctes.append(f"""s{d} AS (SELECT tree, x, node, count(*) OVER nd AS size, [{lows}] AS low, [{highs}] AS high
  FROM l{d} WINDOW nd AS (PARTITION BY tree, node))""")
        ctes.append(f"""u{d} AS (SELECT s{d}.*, CASE WHEN {d} < depth THEN list_filter([1, 2, 3, 4], lambda i: high[i] > low[i])
         ELSE [] END AS usable FROM s{d}, size)""")
        ctes.append(f"""f{d} AS (SELECT *, CASE WHEN len(usable) > 0 THEN
    usable[{drawn(str(seed), "tree", "node", "'feature'")} % len(usable) + 1] END AS feature FROM u{d})""")
        ctes.append(f"""c{d} AS (SELECT *, low[feature] + {drawn(str(seed), "tree", "node", "'cut'")} / {float(1 << 52)}::DOUBLE
    * (high[feature] - low[feature]) AS cut FROM f{d})""")
        ctes.append(f"""t{d} AS MATERIALIZED (SELECT tree, x, node, size, feature,
    CASE WHEN cut > low[feature] AND cut <= high[feature] THEN cut ELSE high[feature] END AS threshold FROM c{d})""")
        ctes.append(f"""l{d + 1} AS MATERIALIZED (SELECT tree, x, 2 * node + CAST(x[feature] >= threshold AS BIGINT) AS node
    FROM t{d} WHERE feature IS NOT NULL)""")
        parts.append(f"SELECT DISTINCT tree, node, feature, threshold, size, {d} AS depth FROM t{d}")
    ctes.append("nodes AS MATERIALIZED (" + " UNION ALL ".join(parts) + ")")
    ctes.append(f"w0 AS (SELECT {key}, [{filled}] AS x, tree, CAST(1 AS BIGINT) AS node "
                f"FROM apply, means, (SELECT unnest(range({trees})) AS tree))")
    ends = []
    for d in range(len(parts)):
        ctes.append(f"v{d} AS MATERIALIZED (SELECT w.*, feature, threshold, size FROM w{d} w JOIN nodes USING (tree, node))")
        ends.append(f"SELECT {key}, CAST(round(({d} + {c('size')}) / 1e-9) AS BIGINT) AS path FROM v{d} WHERE feature IS NULL")
        ctes.append(f"w{d + 1} AS (SELECT {key}, x, tree, 2 * node + CAST(x[feature] >= threshold AS BIGINT) AS node "
                    f"FROM v{d} WHERE feature IS NOT NULL)")
    ctes.append("raw AS MATERIALIZED (SELECT %s, round(CASE WHEN any_value(psi) > 1 THEN -pow(2.0, -(sum(path)::DOUBLE / %r::DOUBLE) / "
                "any_value(%s)) ELSE -0.5 END, 12) AS r FROM (%s), size GROUP BY %s)"
                % (key, trees / 1e-9, c("psi"), " UNION ALL ".join(ends), key))
    fit_raw = "raw"
    if fitted != scored:  # the threshold comes from the entities that were fitted
        more = [c_.replace("w0 AS", "fw0 AS").replace("FROM apply", "FROM train") for c_ in ctes if c_.startswith("w0 AS")]
        fends = []
        for d in range(len(parts)):
            more.append(f"fv{d} AS MATERIALIZED (SELECT w.*, feature, threshold, size FROM fw{d} w JOIN nodes USING (tree, node))")
            fends.append(f"SELECT {key}, CAST(round(({d} + {c('size')}) / 1e-9) AS BIGINT) AS path FROM fv{d} WHERE feature IS NULL")
            more.append(f"fw{d + 1} AS (SELECT {key}, x, tree, 2 * node + CAST(x[feature] >= threshold AS BIGINT) AS node "
                        f"FROM fv{d} WHERE feature IS NOT NULL)")
        more.append(ctes[-1].replace("raw AS", "fraw AS", 1).replace(" UNION ALL ".join(ends), " UNION ALL ".join(fends)))
        ctes, fit_raw = ctes + more, "fraw"
    ctes.append(f"""ordered AS (SELECT list(r ORDER BY r) AS v, {contamination}::DOUBLE * (count(*) - 1) AS pos FROM {fit_raw}),
border AS (SELECT round(v[CAST(floor(pos) AS BIGINT) + 1] + (v[CAST(ceil(pos) AS BIGINT) + 1]
                  - v[CAST(floor(pos) AS BIGINT) + 1]) * (pos - floor(pos)), 12) AS o FROM ordered),
judged AS (SELECT apply.*, round(r - o, 12) AS anomaly_score, round(r - o, 12) < 0 AS is_anomaly
           FROM apply JOIN raw USING ({key}), border)
""")
    return BINDING + ", " + ",\n".join(ctes)


REQ_COLS = ("request_id, msisdn, enterprise_id, country_iso, mcc, mnc, ip, channel, event_ts")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["parse_requests"] = BINDING + f"""
SELECT {REQ_COLS} FROM requests_raw WHERE event_id % 97 <> 0"""
    q["quarantine_requests"] = BINDING + """
SELECT request_id AS key, 'not-json' AS value FROM requests_raw WHERE event_id % 97 = 0"""
    q["dedupe_requests"] = BINDING + "SELECT * FROM requests"
    q["dedupe_latest_delivery"] = BINDING + """
SELECT request_id,
       CASE WHEN request_id LIKE '%3' THEN 'expired' ELSE status END AS status,
       operator_latency_ms,
       CASE WHEN request_id LIKE '%3' THEN delivery_ts + INTERVAL 1 SECOND ELSE delivery_ts END
         AS event_ts
FROM delivery"""
    q["silver_events"] = BINDING + "SELECT * FROM silver"
    q["verified_membership"] = BINDING + """
SELECT r.*, (r.request_id IN (SELECT request_id FROM verification WHERE outcome = 'verified'))
         AS is_verified
FROM (SELECT * EXCLUDE (event_id) FROM requests_raw) r"""

    q["delivery_funnel"] = BINDING + "SELECT * FROM funnel"
    names = ["p50_latency_ms", "p90_latency_ms", "p99_latency_ms"]
    q["latency_pct"] = BINDING + _disc_pct("operator_latency_ms", ["mcc", "mnc"],
                                           [0.5, 0.9, 0.99], names)
    q["ait_loss"] = BINDING + "SELECT * FROM loss"
    q["ait_loss_top"] = BINDING + """
SELECT * FROM loss ORDER BY estimated_ait_loss_usd DESC, enterprise_id, mcc, mnc LIMIT 10"""
    q["ait_loss_by_route"] = BINDING + """
SELECT mcc, mnc, CAST(sum(requested) AS BIGINT) AS requested,
       sum(estimated_ait_loss_usd) AS estimated_ait_loss_usd
FROM loss GROUP BY 1, 2"""
    q["funnel_by_country_day"] = BINDING + """
SELECT country_iso, date_trunc('day', event_ts) AS bucket_start, count(*) AS requested,
    count_if(delivery_status = 'delivered') AS delivered, count_if(is_verified) AS verified,
    round(CAST(count_if(is_verified) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0.0), 4)
      AS verify_rate
FROM silver GROUP BY 1, 2"""
    q["verify_latency_pct"] = BINDING + _disc_pct(
        "(epoch_ms(verification_ts) - epoch_ms(delivery_ts))", ["mcc", "mnc"], [0.5, 0.9, 0.99],
        ["p50_verify_ms", "p90_verify_ms", "p99_verify_ms"])
    q["operator_performance"] = BINDING + f"""
, pct AS ({_disc_pct("operator_latency_ms", ["mcc", "mnc"], [0.5, 0.9],
                     ["p50_latency_ms", "p90_latency_ms"])})
SELECT b.*, pct.p50_latency_ms, pct.p90_latency_ms
FROM (SELECT mcc, mnc, count(*) AS requested, count_if(delivery_status = 'delivered') AS delivered,
             count_if(delivery_status IS NULL) AS undelivered,
             avg(operator_latency_ms) AS avg_latency_ms,
             round(CAST(count_if(delivery_status = 'delivered') AS DOUBLE)
                   / nullif(CAST(count(*) AS DOUBLE), 0.0), 4) AS delivery_rate
      FROM silver GROUP BY 1, 2) b
LEFT JOIN pct ON b.mcc = pct.mcc AND b.mnc = pct.mnc"""

    for mart in ("delivery_funnel", "latency_pct", "verify_latency_pct", "operator_performance"):
        q[f"{mart}_by_day"] = q[mart]
    q["fraud_aggregate_batch"] = BINDING + """
SELECT enterprise_id, substr(msisdn, 1, 6) AS number_range, mcc, mnc, count(*) AS requests
FROM requests_raw GROUP BY ALL"""
    q["fraud_aggregate_verified"] = BINDING + """
, flagged AS (
  SELECT r.*, substr(r.msisdn, 1, 6) AS number_range,
         CAST(r.request_id IN (SELECT request_id FROM verification WHERE outcome = 'verified')
              AS BIGINT) AS v
  FROM requests_raw r)
SELECT t.*, i.distinct_ip
FROM (SELECT enterprise_id, number_range, mcc, mnc, CAST(sum(n) AS BIGINT) AS requests,
             CAST(sum(sv) AS BIGINT) AS verifications, max(n) AS msisdn_max_count
      FROM (SELECT enterprise_id, number_range, mcc, mnc, msisdn, count(*) AS n, sum(v) AS sv
            FROM flagged GROUP BY ALL) GROUP BY ALL) t
JOIN (SELECT enterprise_id, number_range, mcc, mnc, count(DISTINCT ip) AS distinct_ip
      FROM flagged GROUP BY ALL) i
ON t.enterprise_id IS NOT DISTINCT FROM i.enterprise_id
   AND t.number_range IS NOT DISTINCT FROM i.number_range
   AND t.mcc IS NOT DISTINCT FROM i.mcc AND t.mnc IS NOT DISTINCT FROM i.mnc"""
    q["rule_scores"] = _with(_AGG_SILVER, _SCORED) + "SELECT * FROM scored"
    q["fraud_alerts"] = _with(_AGG_SILVER, _SCORED) + \
        "SELECT * FROM scored WHERE severity <> 'low'"
    q["alerts_by_severity"] = _with(_AGG_SILVER, _SCORED) + """
SELECT severity, count(*) AS alert_count FROM scored WHERE severity <> 'low' GROUP BY 1"""
    q["windowed_aggregate_tumbling"] = BINDING + """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end,
       enterprise_id, number_range, mcc, mnc, CAST(sum(n) AS BIGINT) AS requests,
       CAST(sum(v) AS BIGINT) AS verifications, max(n) AS msisdn_max_count
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start,
             enterprise_id, number_range, mcc, mnc, msisdn, count(*) AS n,
             sum(CAST(is_verified AS BIGINT)) AS v
      FROM silver WHERE event_ts IS NOT NULL GROUP BY ALL)
GROUP BY ALL"""
    q["windowed_alerts_daily"] = _with(_DAILY) + "SELECT * EXCLUDE (created_at) FROM dalerts"
    q["fraud_daily"] = _with(_DAILY) + """
SELECT CAST(created_at AS DATE) AS day, severity, count(*) AS alert_count
FROM dalerts GROUP BY 1, 2"""
    q["fraud_daily_by_dimension"] = _with(_DAILY) + """
SELECT CAST(created_at AS DATE) AS day, severity, enterprise_id, mcc, mnc,
       count(*) AS alert_count
FROM dalerts GROUP BY ALL"""
    vel = []
    for d in ("msisdn", "ip", "enterprise_id", "number_range"):
        vel.append(f"""
SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, ws AS window_start,
       ws + INTERVAL 5 MINUTE AS window_end, count(*) AS requests, count(*) > 30 AS over_ceiling
FROM (SELECT {d}, unnest(generate_series(time_bucket(INTERVAL 1 MINUTE, event_ts)
                                         - INTERVAL 4 MINUTE,
                                         time_bucket(INTERVAL 1 MINUTE, event_ts),
                                         INTERVAL 1 MINUTE)) AS ws
      FROM silver WHERE event_ts IS NOT NULL)
GROUP BY 1, 2, 3, 4""")
    q["sliding_velocity_by_dimension"] = BINDING + "\nUNION ALL\n".join(vel)
    over = []
    for d in ("msisdn", "ip", "enterprise_id", "number_range"):
        over.append(f"""
SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, ws AS window_start,
       ws + INTERVAL 1 HOUR AS window_end, count(*) AS requests
FROM (SELECT {d}, unnest(generate_series(time_bucket(INTERVAL 10 MINUTE, event_ts)
                                         - INTERVAL 50 MINUTE,
                                         time_bucket(INTERVAL 10 MINUTE, event_ts),
                                         INTERVAL 10 MINUTE)) AS ws
      FROM silver WHERE event_ts IS NOT NULL AND {d} IS NOT NULL)
GROUP BY 1, 2, 3, 4 HAVING count(*) > 3""")
    q["velocity_alerts_by_dimension"] = BINDING + "\nUNION ALL\n".join(over)
    q["never_verified_msisdn"] = BINDING + """
SELECT msisdn, count(*) AS requests, CAST(sum(CAST(is_verified AS BIGINT)) AS BIGINT) AS verifications
FROM silver GROUP BY 1 HAVING count(*) >= 10 AND sum(CAST(is_verified AS BIGINT)) = 0"""

    q["entity_features"] = BINDING + """
SELECT enterprise_id, count(*) AS requests, avg(CAST(is_verified AS DOUBLE)) AS verify_rate,
       avg(CAST(operator_latency_ms AS DOUBLE)) AS avg_latency,
       count(DISTINCT number_range) AS range_spread
FROM silver WHERE enterprise_id IS NOT NULL GROUP BY 1"""
    q["entity_features_by_range"] = BINDING + """
SELECT enterprise_id, number_range, count(*) AS requests,
       avg(CAST(is_verified AS DOUBLE)) AS verify_rate,
       avg(CAST(operator_latency_ms AS DOUBLE)) AS avg_latency,
       count(DISTINCT number_range) AS range_spread
FROM silver WHERE enterprise_id IS NOT NULL AND number_range IS NOT NULL GROUP BY 1, 2"""
    ranges = ("enterprise_id", "number_range")
    q["anomaly_scores"] = _forest_sql(("enterprise_id",)) + "SELECT * FROM judged"
    q["anomaly_scores_by_range"] = _forest_sql(ranges) + "SELECT * FROM judged"
    q["anomaly_scores_sampled"] = _forest_sql(("msisdn",), trees=25, psi=64) + "SELECT * FROM judged"
    q["anomaly_worst"] = _forest_sql(ranges) + \
        "SELECT * FROM judged ORDER BY anomaly_score, enterprise_id, number_range LIMIT 5"
    last = "CAST(event_ts AS DATE) {} (SELECT max(CAST(event_ts AS DATE)) FROM silver)"
    q["anomaly_saved_model"] = _forest_sql(ranges, fitted=last.format("<"), scored=last.format("=")) + \
        "SELECT * FROM judged"
    q["quality_silver"] = BINDING + """
SELECT 'not_null' AS "check", 'request_id' AS target, count_if(request_id IS NULL) AS failed_rows,
       count_if(request_id IS NULL) = 0 AS ok FROM silver
UNION ALL
SELECT 'in_set', 'is_verified', count_if(NOT coalesce(is_verified IN (true, false), false)),
       count_if(NOT coalesce(is_verified IN (true, false), false)) = 0 FROM silver"""
    q["quality_marts"] = BINDING + """
, lat AS (SELECT DISTINCT mcc, mnc FROM silver WHERE operator_latency_ms IS NOT NULL)
SELECT 'not_null' AS "check", 'delivery_funnel.enterprise_id' AS target,
       count_if(enterprise_id IS NULL) AS failed_rows, count_if(enterprise_id IS NULL) = 0 AS ok
FROM funnel
UNION ALL
SELECT 'accepted_range', 'delivery_funnel.verify_rate',
       count_if(coalesce(verify_rate < 0 OR verify_rate > 1, false)),
       count_if(coalesce(verify_rate < 0 OR verify_rate > 1, false)) = 0 FROM funnel
UNION ALL
SELECT 'not_null', 'latency_pct.mcc', count_if(mcc IS NULL), count_if(mcc IS NULL) = 0 FROM lat
UNION ALL
SELECT 'not_null', 'ait_loss.estimated_ait_loss_usd', count_if(estimated_ait_loss_usd IS NULL),
       count_if(estimated_ait_loss_usd IS NULL) = 0 FROM loss"""
    q["quality_relations"] = BINDING + """
, rr AS (SELECT * EXCLUDE (event_id) FROM requests_raw),
u1 AS (SELECT coalesce(sum(c), 0) AS n FROM (SELECT request_id, count(*) AS c FROM rr GROUP BY 1 HAVING count(*) > 1)),
u2 AS (SELECT coalesce(sum(c), 0) AS n FROM (SELECT request_id, count(*) AS c FROM delivery GROUP BY 1 HAVING count(*) > 1)),
o1 AS (SELECT count(*) AS n FROM delivery d WHERE d.request_id IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM rr WHERE rr.request_id = d.request_id)),
o2 AS (SELECT count(*) AS n FROM verification v WHERE v.request_id IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM rr WHERE rr.request_id = v.request_id)),
a1 AS (SELECT count_if(status IS NOT NULL AND status NOT IN ('delivered', 'failed', 'expired')) AS n FROM delivery),
a2 AS (SELECT count_if(outcome IS NOT NULL AND outcome NOT IN ('verified', 'failed', 'timeout')) AS n FROM verification),
a3 AS (SELECT count_if(channel IS NOT NULL AND channel NOT IN ('sms', 'voice', 'whatsapp')) AS n FROM rr)
SELECT 'unique' AS "check", 'requests.request_id' AS target, CAST(n AS BIGINT) AS failed_rows, n = 0 AS ok FROM u1
UNION ALL SELECT 'unique', 'delivery.request_id', CAST(n AS BIGINT), n = 0 FROM u2
UNION ALL SELECT 'relationship', 'delivery.request_id', n, n = 0 FROM o1
UNION ALL SELECT 'relationship', 'verification.request_id', n, n = 0 FROM o2
UNION ALL SELECT 'accepted_values', 'delivery.status', n, n = 0 FROM a1
UNION ALL SELECT 'accepted_values', 'verification.outcome', n, n = 0 FROM a2
UNION ALL SELECT 'accepted_values', 'requests.channel', n, n = 0 FROM a3"""
    q["layer_reconciliation"] = BINDING + """
SELECT 'source' AS layer, (SELECT count(*) FROM events) AS rows, CAST(NULL AS BIGINT) AS expected,
       true AS ok
UNION ALL
SELECT 'bronze_requests', (SELECT count(*) FROM requests_raw), NULL, true
UNION ALL
SELECT 'silver', (SELECT count(*) FROM silver), (SELECT count(DISTINCT request_id) FROM requests_raw),
       (SELECT count(*) FROM silver) = (SELECT count(DISTINCT request_id) FROM requests_raw)"""
    layers = BINDING + """
, n AS (SELECT count(*) AS messages, count_if(event_id % 97 <> 0) AS bronze,
               count_if(event_id % 97 = 0) AS quarantined,
               count(DISTINCT CASE WHEN event_id % 97 <> 0 THEN request_id END) AS ids
        FROM requests_raw)
"""
    q["bronze_reconciliation"] = layers + """
SELECT 'messages' AS layer, messages AS rows, bronze + quarantined AS expected,
       messages = bronze + quarantined AS ok FROM n
UNION ALL SELECT 'bronze_requests', bronze, messages - quarantined, bronze = messages - quarantined FROM n
UNION ALL SELECT 'silver', ids, ids, true FROM n"""
    q["bronze_reconciliation_broken"] = layers + """
SELECT 'messages' AS layer, messages AS rows, bronze AS expected, messages = bronze AS ok FROM n
UNION ALL SELECT 'bronze_requests', bronze, messages - quarantined, bronze = messages - quarantined FROM n
UNION ALL SELECT 'silver', bronze, ids, bronze = ids FROM n"""
    return q


# Streaming replays: malformed request messages (event_id % 97 = 0) are quarantined, so the
# streamed aggregates see requests_raw without them.
_PARSED = """
parsed AS (SELECT * EXCLUDE (event_id), substr(msisdn, 1, 6) AS number_range
           FROM requests_raw WHERE event_id % 97 <> 0)
"""
_VERIFIED_STREAM = """
sreq AS (SELECT DISTINCT * FROM parsed),
sflag AS (SELECT s.*, CAST(s.request_id IN (SELECT request_id FROM verification
                                            WHERE outcome = 'verified') AS BIGINT) AS v
          FROM sreq s)
"""


def streaming_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    base = oracle_sql()
    q["stream_bronze_landing"] = base["parse_requests"]
    q["compact_streamed_bronze"] = base["parse_requests"]
    q["stream_bronze_quarantine"] = base["quarantine_requests"]
    q["stream_dedupe"] = BINDING + f", {_PARSED} SELECT DISTINCT * EXCLUDE (number_range) FROM parsed"
    q["stream_windowed_aggregate"] = BINDING + f", {_PARSED}" + """
SELECT time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, event_ts) + INTERVAL 5 MINUTE AS window_end,
       enterprise_id, number_range, mcc, mnc, count(*) AS requests
FROM parsed WHERE event_ts IS NOT NULL GROUP BY ALL"""
    q["stream_window_restarts"] = q["stream_windowed_aggregate"]
    q["stream_late_rows"] = BINDING + f", {_PARSED}" + """
, timed AS (SELECT *, CAST(request_id AS BIGINT) % 53 = 0 AS late,
                   time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start,
                   time_bucket(INTERVAL 5 MINUTE, event_ts) + INTERVAL 5 MINUTE AS window_end
            FROM parsed WHERE event_ts IS NOT NULL),
mark AS (SELECT max(event_ts) - INTERVAL 10 MINUTE AS w FROM timed WHERE NOT late)
SELECT window_start, window_end, enterprise_id, number_range, mcc, mnc, count(*) AS requests
FROM timed, mark WHERE NOT late OR window_end > w GROUP BY ALL"""
    q["stream_sliding_msisdn_max"] = BINDING + f", {_PARSED}" + """
SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, enterprise_id, number_range,
       mcc, mnc, CAST(sum(n) AS BIGINT) AS requests, max(n) AS msisdn_max_count
FROM (SELECT ws, enterprise_id, number_range, mcc, mnc, msisdn, count(*) AS n
      FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, event_ts) - INTERVAL 30 MINUTE,
                              time_bucket(INTERVAL 30 MINUTE, event_ts)]) AS ws
            FROM parsed WHERE event_ts IS NOT NULL)
      GROUP BY ALL)
GROUP BY ALL"""
    q["stream_distinct_ip_panes"] = BINDING + f", {_PARSED}" + """
, spread AS (
  SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, event_ts) - INTERVAL 30 MINUTE,
                    time_bucket(INTERVAL 30 MINUTE, event_ts)]) AS ws,
         CAST('0x' || substr(md5(ip), 1, 3) AS BIGINT) AS register,
         CAST('0x' || substr(md5(ip), 4, 13) AS BIGINT) AS rest
  FROM parsed WHERE event_ts IS NOT NULL),
registers AS (
  SELECT ws, enterprise_id, number_range, mcc, mnc, register,
         max(CASE WHEN rest = 0 THEN 53 ELSE 53 - length(bin(rest)) END) AS level
  FROM spread GROUP BY ALL),
sums AS (
  SELECT ws, enterprise_id, number_range, mcc, mnc, 4096 - count(register) AS empty,
         coalesce(sum(power(2.0::DOUBLE, -level)), 0) AS s
  FROM registers GROUP BY ALL),
raws AS (SELECT *, (0.7213::DOUBLE / (1 + 1.079::DOUBLE / 4096) * 4096 * 4096) / (s + empty) AS raw FROM sums),
exact AS (SELECT ws, enterprise_id, number_range, mcc, mnc, count(DISTINCT ip) AS distinct_ip
          FROM spread GROUP BY ws, enterprise_id, number_range, mcc, mnc)
SELECT e.ws AS window_start, e.ws + INTERVAL 1 HOUR AS window_end, e.enterprise_id, e.number_range, e.mcc, e.mnc,
       distinct_ip, CAST(round(CASE WHEN raw <= 10240 AND empty > 0 THEN 4096 * ln(4096.0::DOUBLE / empty)
                                    ELSE raw END) AS BIGINT) AS estimate
FROM exact e JOIN raws r ON e.ws = r.ws AND e.enterprise_id IS NOT DISTINCT FROM r.enterprise_id
 AND e.number_range IS NOT DISTINCT FROM r.number_range
 AND e.mcc IS NOT DISTINCT FROM r.mcc AND e.mnc IS NOT DISTINCT FROM r.mnc"""
    q["stream_update_msisdn_max"] = q["stream_sliding_msisdn_max"]
    m = _score_sql(ver="")
    q["stream_update_msisdn_late"] = BINDING + f", {_PARSED}" + f"""
, timed AS (SELECT *, CAST(request_id AS BIGINT) % 53 = 0 AS late,
                   time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start,
                   time_bucket(INTERVAL 5 MINUTE, event_ts) + INTERVAL 5 MINUTE AS window_end
            FROM parsed WHERE event_ts IS NOT NULL),
mark AS (SELECT max(event_ts) - INTERVAL 10 MINUTE AS w FROM timed WHERE NOT late),
agg AS (SELECT window_start, window_end, enterprise_id, number_range, mcc, mnc,
               CAST(sum(n) AS BIGINT) AS requests, max(n) AS msisdn_max_count
        FROM (SELECT window_start, window_end, enterprise_id, number_range, mcc, mnc, msisdn, count(*) AS n
              FROM timed, mark WHERE NOT late OR window_end > w GROUP BY ALL) GROUP BY ALL)
SELECT *, {m['score']} AS score, {m['severity']} AS severity FROM agg"""
    q["stream_fraud_alerts"] = BINDING + f", {_PARSED}, {_VERIFIED_STREAM}" + f"""
, dagg AS (
  SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, enterprise_id, number_range,
         mcc, mnc, CAST(sum(n) AS BIGINT) AS requests, CAST(sum(sv) AS BIGINT) AS verifications,
         max(n) AS msisdn_max_count
  FROM (SELECT date_trunc('day', event_ts) AS window_start, enterprise_id, number_range, mcc,
               mnc, msisdn, count(*) AS n, sum(v) AS sv
        FROM sflag WHERE event_ts IS NOT NULL GROUP BY ALL)
  GROUP BY ALL)
SELECT *, {_D['score']} AS score, {_D['severity']} AS severity FROM dagg
WHERE {_D['severity']} <> 'low'"""
    q["stream_alerts_revised"] = q["stream_fraud_alerts"]
    q["alert_revision_changes"] = BINDING + f", {_PARSED}, {_VERIFIED_STREAM}" + f"""
, flags AS (
  SELECT s.* EXCLUDE (v), 0 AS told, v FROM sflag s
  UNION ALL
  SELECT s.*, 1, CAST(EXISTS (SELECT 1 FROM verification x WHERE x.request_id = s.request_id
                      AND x.outcome = 'verified' AND x.verification_ts >= s.event_ts
                      AND x.verification_ts <= s.event_ts + INTERVAL 30 SECOND) AS BIGINT) FROM sreq s),
agg AS (
  SELECT told, window_start, window_start + INTERVAL 1 DAY AS window_end, enterprise_id, number_range,
         mcc, mnc, CAST(sum(n) AS BIGINT) AS requests, CAST(sum(sv) AS BIGINT) AS verifications,
         max(n) AS msisdn_max_count
  FROM (SELECT told, date_trunc('day', event_ts) AS window_start, enterprise_id, number_range, mcc,
               mnc, msisdn, count(*) AS n, sum(v) AS sv
        FROM flags WHERE event_ts IS NOT NULL GROUP BY ALL)
  GROUP BY ALL),
marked AS (SELECT *, {_D['score']} AS score, {_D['severity']} AS severity FROM agg),
pairs AS (
  SELECT f.*, t.verifications AS told_verifications, t.score AS told_score,
         t.severity AS told_severity
  FROM (SELECT * EXCLUDE (told) FROM marked WHERE told = 0) f
  LEFT JOIN (SELECT * FROM marked WHERE told = 1 AND severity <> 'low') t
    ON f.window_start = t.window_start AND f.enterprise_id IS NOT DISTINCT FROM t.enterprise_id
   AND f.number_range IS NOT DISTINCT FROM t.number_range
   AND f.mcc IS NOT DISTINCT FROM t.mcc AND f.mnc IS NOT DISTINCT FROM t.mnc),
feed AS (
  SELECT *, CASE WHEN told_severity IS NULL THEN 'new' WHEN severity = 'low' THEN 'withdrawn'
                 WHEN verifications = told_verifications THEN 'kept' ELSE 'changed' END AS change
  FROM pairs WHERE severity <> 'low' OR told_severity IS NOT NULL)
SELECT 0 AS revision, * EXCLUDE (msisdn_max_count) FROM feed
UNION ALL BY NAME
SELECT 1 AS revision, * EXCLUDE (msisdn_max_count, change, told_verifications, told_score, told_severity),
       'kept' AS change, verifications AS told_verifications, score AS told_score,
       severity AS told_severity FROM feed WHERE severity <> 'low'"""
    svel = []
    for d in ("msisdn", "ip", "enterprise_id", "number_range"):
        svel.append(f"""
SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, ws AS window_start,
       ws + INTERVAL 5 MINUTE AS window_end, count(*) AS requests, count(*) > 30 AS over_ceiling
FROM (SELECT {d}, unnest(generate_series(time_bucket(INTERVAL 1 MINUTE, event_ts)
                                         - INTERVAL 4 MINUTE,
                                         time_bucket(INTERVAL 1 MINUTE, event_ts),
                                         INTERVAL 1 MINUTE)) AS ws
      FROM (SELECT DISTINCT * FROM parsed) WHERE event_ts IS NOT NULL)
GROUP BY 1, 2, 3, 4""")
    q["stream_velocity_by_dimension"] = BINDING + f", {_PARSED}" + "\nUNION ALL\n".join(svel)
    s = _score_sql(ver="", mx="")
    q["stream_update_alerts"] = BINDING + f", {_PARSED}" + f"""
, agg AS (SELECT date_trunc('day', event_ts) AS window_start,
                 date_trunc('day', event_ts) + INTERVAL 1 DAY AS window_end,
                 enterprise_id, number_range, mcc, mnc, count(*) AS requests
          FROM parsed WHERE event_ts IS NOT NULL GROUP BY ALL)
SELECT *, {s['score']} AS score, {s['severity']} AS severity FROM agg
WHERE {s['severity']} <> 'low'"""
    q["stream_update_batches"] = q["stream_update_alerts"]
    q["stream_micro_batch_scoring"] = BINDING + f", {_PARSED}" + f"""
, agg AS (SELECT enterprise_id, number_range, mcc, mnc, count(*) AS requests FROM parsed
          GROUP BY ALL)
SELECT *, {s['score']} AS score, {s['severity']} AS severity FROM agg"""
    return q


def sink_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["route_enrichment"] = BINDING + """
, routes AS (SELECT * FROM (VALUES
    ('247', '1', 'LV', 'lv-premium-range', true),
    ('88', '0', 'XX', 'international-shared', true),
    ('881', '0', 'XS', 'global-satellite', true),
    ('310', '260', 'US', 'us-mobile-260', false),
    ('404', '45', 'IN', 'in-mobile-45', false),
    ('234', '10', 'GB', 'gb-mobile-10', false),
    ('724', '5', 'BR', 'br-mobile-5', false)) t(mcc, mnc, route_country, operator, high_risk))
SELECT s.*, r.route_country, r.operator, r.high_risk
FROM silver s LEFT JOIN routes r ON s.mcc = r.mcc AND s.mnc = r.mnc"""
    q["alert_payload"] = _with(_DAILY) + """
SELECT concat_ws('|', strftime(window_start, '%Y-%m-%dT%H:%M:%S.%f'), enterprise_id, number_range,
                 mcc, mnc) AS key,
       to_json(struct_pack(window_start := strftime(window_start, '%Y-%m-%dT%H:%M:%S.%f'),
                           window_end := strftime(window_end, '%Y-%m-%dT%H:%M:%S.%f'),
                           enterprise_id := enterprise_id, number_range := number_range,
                           mcc := mcc, mnc := mnc, requests := requests,
                           verifications := verifications, msisdn_max_count := msisdn_max_count,
                           distinct_ip := distinct_ip, score := score, severity := severity))
         AS value
FROM dalerts"""
    q["partitioned_layout"] = BINDING + """
SELECT *, CAST(event_ts AS DATE) AS event_date FROM silver"""
    q["compact_preserves_rows"] = BINDING + """
SELECT *, CAST(event_ts AS DATE) AS event_date FROM silver"""
    q["alerts_jdbc_roundtrip"] = _with(_AGG_SILVER, _SCORED) + """
SELECT enterprise_id, number_range, mcc, mnc, requests, score, severity
FROM scored WHERE severity <> 'low'"""
    q["silver_job_full_then_days"] = q["compact_preserves_rows"]
    return q
