"""Oracle SQL (DuckDB dialect) for each registered query.

Tables ``events`` and ``part`` (and the others) are views over the same
parquet files the Spark queries read.  The adapter CTEs mirror
``sources/tables.py`` exactly.
"""

from __future__ import annotations

EV = """ev AS (
  SELECT event_id,
         CAST(user_id AS VARCHAR) AS user_id,
         json_extract_string(props, '$.k') AS content_id,
         event_type,
         CAST(round(value * 1000) AS BIGINT) AS dwell_time_ms,
         ts
  FROM events)"""

META = """meta_v AS (
  SELECT CAST(p_partkey AS VARCHAR) AS content_id, p_type AS category,
         p_brand AS creator_id, CAST(1 AS BIGINT) AS seq
  FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), lower(p_type), p_brand, CAST(2 AS BIGINT)
  FROM part WHERE p_partkey % 7 = 0),
meta AS (
  SELECT content_id, arg_max(category, seq) AS category,
         arg_max(creator_id, seq) AS creator_id, max(seq) AS seq
  FROM meta_v GROUP BY content_id)"""

USER_HOURLY = """uh AS (
  SELECT user_id,
         date_trunc('hour', ts) AS window_start,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
         CAST(SUM(CASE WHEN lower(event_type) = 'click' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS click_rate,
         CAST(SUM(COALESCE(dwell_time_ms, 0)) AS DOUBLE) / COUNT(*) AS avg_dwell_time,
         COUNT(*) AS event_count
  FROM ev GROUP BY 1, 2, 3)"""

CONTENT_SLIDING = """cs AS (
  SELECT content_id, window_start, window_start + INTERVAL 15 MINUTE AS window_end,
         SUM(CASE WHEN lower(event_type) = 'view' THEN 1 ELSE 0 END) AS view_count,
         SUM(CASE WHEN lower(event_type) IN ('purchase', 'signup') THEN 1 ELSE 0 END) AS engagement_count,
         COUNT(*) AS event_count
  FROM (SELECT content_id, event_type,
               time_bucket(INTERVAL 5 MINUTE, ts) - i * INTERVAL 5 MINUTE AS window_start
        FROM (SELECT *, unnest([0, 1, 2]) AS i FROM ev))
  GROUP BY 1, 2, 3)"""

AFFINITY_STREAM = """af AS (
  SELECT e.user_id,
         date_trunc('hour', e.ts) AS window_start,
         date_trunc('hour', e.ts) + INTERVAL 1 HOUR AS window_end,
         m.category,
         COUNT(*) AS category_affinity_score,
         'category_affinity_' || m.category AS feature_name
  FROM ev e JOIN meta m ON e.content_id = m.content_id
  GROUP BY 1, 2, 3, 4)"""

SQL: dict[str, str] = {}

SQL["q01_user_hourly_features"] = f"""
WITH {EV}, {USER_HOURLY}
SELECT * FROM uh"""

SQL["q02_user_features_long"] = f"""
WITH {EV}, {USER_HOURLY}
SELECT user_id AS entity_id, 'click_rate' AS feature_name, click_rate AS feature_value,
       window_start, window_end, window_end + INTERVAL 30 SECOND AS computed_at FROM uh
UNION ALL
SELECT user_id, 'avg_dwell_time', avg_dwell_time,
       window_start, window_end, window_end + INTERVAL 30 SECOND FROM uh"""

SQL["q03_content_engagement_sliding"] = f"""
WITH {EV}, {CONTENT_SLIDING}
SELECT content_id, window_start, window_end,
       CASE WHEN view_count > 0 THEN CAST(engagement_count AS DOUBLE) / view_count ELSE 0.0 END AS engagement_rate,
       CAST(view_count AS BIGINT) AS view_count,
       CAST(engagement_count AS BIGINT) AS engagement_count,
       event_count
FROM cs"""

SQL["q04_content_engagement_15m"] = f"""
WITH {EV}
SELECT content_id,
       time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end,
       CASE WHEN SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) > 0
            THEN CAST(SUM(CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END) AS DOUBLE)
                 / SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)
            ELSE 0.0 END AS engagement_rate,
       CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS view_count
FROM ev GROUP BY 1, 2, 3"""

SQL["q05_category_affinity_stream"] = f"""
WITH {EV}, {META}, {AFFINITY_STREAM}
SELECT * FROM af"""

SQL["q06_category_affinity_batch"] = f"""
WITH {EV}, {META}
SELECT e.user_id,
       date_trunc('hour', e.ts) AS window_start,
       date_trunc('hour', e.ts) + INTERVAL 1 HOUR AS window_end,
       COALESCE(m.category, 'unknown') AS category,
       COUNT(*) AS category_affinity_score,
       'category_affinity_' || COALESCE(m.category, 'unknown') AS feature_name
FROM ev e LEFT JOIN meta m ON e.content_id = m.content_id
GROUP BY 1, 2, 3, 4"""

SQL["q07_latest_metadata"] = f"""
WITH {META}
SELECT content_id, category, creator_id, seq FROM meta"""

SQL["q08_enriched_events"] = f"""
WITH {EV}, {META}
SELECT e.event_id, e.user_id, e.content_id, e.event_type, e.dwell_time_ms, e.ts,
       m.category, m.creator_id
FROM ev e LEFT JOIN meta m ON e.content_id = m.content_id"""

ALL_FEATURES = f"""{EV}, {META}, {USER_HOURLY}, {CONTENT_SLIDING}, {AFFINITY_STREAM},
feats AS (
  SELECT user_id AS entity_id, 'click_rate' AS feature_name, click_rate AS feature_value,
         window_start, window_end FROM uh
  UNION ALL
  SELECT user_id, 'avg_dwell_time', avg_dwell_time, window_start, window_end FROM uh
  UNION ALL
  SELECT content_id, 'engagement_rate',
         CASE WHEN view_count > 0 THEN CAST(engagement_count AS DOUBLE) / view_count ELSE 0.0 END,
         window_start, window_end FROM cs
  UNION ALL
  SELECT user_id, feature_name, CAST(category_affinity_score AS DOUBLE),
         window_start, window_end FROM af),
features AS (
  SELECT *, window_end + INTERVAL 30 SECOND AS computed_at FROM feats)"""

SQL["q20_all_features_union"] = f"""
WITH {ALL_FEATURES}
SELECT entity_id, feature_name, feature_value, window_start, window_end, computed_at
FROM features"""

ARRIVALS = """arr AS (
  SELECT *, CASE WHEN event_id % 20 = 0 THEN ts + INTERVAL 3 HOUR ELSE ts END AS arrival_ts
  FROM ev),
wm AS (
  SELECT *, max(ts) OVER (ORDER BY arrival_ts, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_prior
  FROM arr)"""

SQL["q09_late_events_replay"] = f"""
WITH {EV}, {ARRIVALS}
SELECT event_id, user_id, event_type, ts, arrival_ts,
       date_trunc('hour', ts) AS window_start,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end
FROM wm
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= max_prior - INTERVAL 30 SECOND"""

SQL["q10_late_counts_by_delay"] = f"""
WITH {EV}, {META}, {ARRIVALS},
d AS (SELECT unnest([0, 30, 120]) AS delay_s),
x AS (
  SELECT d.delay_s,
         date_trunc('hour', w.ts) + INTERVAL 1 HOUR <= w.max_prior - d.delay_s * INTERVAL 1 SECOND AS user_late,
         time_bucket(INTERVAL 5 MINUTE, w.ts) + INTERVAL 15 MINUTE <= w.max_prior - d.delay_s * INTERVAL 1 SECOND AS content_late,
         m.category IS NOT NULL AS has_cat
  FROM wm w CROSS JOIN d LEFT JOIN meta m ON w.content_id = m.content_id)
SELECT 'user' AS window_family, CAST(delay_s AS INTEGER) AS delay_s,
       CAST(count(*) FILTER (WHERE user_late) AS BIGINT) AS late_count FROM x GROUP BY delay_s
UNION ALL
SELECT 'content', CAST(delay_s AS INTEGER), CAST(count(*) FILTER (WHERE content_late) AS BIGINT) FROM x GROUP BY delay_s
UNION ALL
SELECT 'affinity', CAST(delay_s AS INTEGER), CAST(count(*) FILTER (WHERE user_late AND has_cat) AS BIGINT) FROM x GROUP BY delay_s"""

LATEST = """latest AS (
  SELECT entity_id, feature_name,
         arg_max(feature_value, computed_at) AS feature_value,
         arg_max(window_start, computed_at) AS window_start,
         max(computed_at) AS computed_at,
         arg_max(window_end, computed_at) AS window_end
  FROM features WHERE entity_id IS NOT NULL GROUP BY entity_id, feature_name)"""

SQL["q11_latest_features"] = f"""
WITH {ALL_FEATURES}, {LATEST}
SELECT * FROM latest"""

SQL["q12_entity_lookup"] = f"""
WITH {ALL_FEATURES}, {LATEST}
SELECT * FROM latest WHERE entity_id = '2'"""


def _duration_sql(ms: str) -> str:
    secs = f"(({ms}) + 50) // 100"
    mins = f"(({ms}) + 3000) // 6000"
    return (f"CASE WHEN ({ms}) < 0 THEN '—' "
            f"WHEN ({ms}) < 1000 THEN CAST(({ms}) AS VARCHAR) || ' ms' "
            f"WHEN ({ms}) < 60000 THEN CAST({secs} // 10 AS VARCHAR) || '.' || CAST({secs} % 10 AS VARCHAR) || ' s' "
            f"ELSE CAST({mins} // 10 AS VARCHAR) || '.' || CAST({mins} % 10 AS VARCHAR) || ' min' END")


SQL["q13_feature_freshness"] = f"""
WITH {ALL_FEATURES}, {LATEST},
per AS (SELECT feature_name, max(computed_at) AS last_computed_at, count(*) AS entity_count
        FROM latest GROUP BY feature_name),
wanted AS (SELECT unnest(['click_rate', 'avg_dwell_time', 'engagement_rate']) AS feature_name),
j AS (SELECT COALESCE(p.feature_name, w.feature_name) AS feature_name,
             CAST(COALESCE(p.entity_count, 0) AS BIGINT) AS entity_count,
             p.last_computed_at,
             CAST(COALESCE(epoch_ms(TIMESTAMP '2024-01-31 00:15:00') - epoch_ms(p.last_computed_at), -1) AS BIGINT) AS age_ms
      FROM per p FULL OUTER JOIN wanted w ON p.feature_name = w.feature_name)
SELECT feature_name, entity_count, last_computed_at, age_ms,
       CASE WHEN last_computed_at IS NULL THEN NULL
            ELSE greatest(0.0, 100.0 - CAST(age_ms AS DOUBLE) / 300000.0 * 100.0) END AS freshness_pct,
       {_duration_sql('age_ms')} AS age_text
FROM j"""

SQL["q14_dataset_profile"] = f"""
WITH {ALL_FEATURES}
SELECT (SELECT count(*) FROM ev) AS event_count,
       (SELECT count(DISTINCT user_id) FROM ev) AS distinct_users,
       (SELECT count(DISTINCT content_id) FROM ev) AS distinct_contents,
       (SELECT min(ts) FROM ev) AS min_ts,
       (SELECT max(ts) FROM ev) AS max_ts,
       (SELECT count(*) FROM features) AS total_features,
       (SELECT count(DISTINCT entity_id) FROM features) AS distinct_entities"""

SQL["q15_event_type_counts"] = f"""
WITH {EV}
SELECT event_type, count(*) AS n FROM ev GROUP BY event_type"""

SQL["q18_recent_features"] = f"""
WITH {ALL_FEATURES}
SELECT entity_id, feature_name, feature_value, printf('%.4f', feature_value) AS value_text,
       window_start, window_end, computed_at
FROM features
ORDER BY computed_at DESC, feature_name, entity_id, window_start DESC
LIMIT 60"""

SQL["q21_quarantine_counts"] = f"""
WITH {EV},
r AS (SELECT dwell_time_ms,
             CASE WHEN event_id % 50 <> 0 THEN 'ok'
                  WHEN (event_id // 50) % 3 = 0 THEN 'malformed_json'
                  WHEN (event_id // 50) % 3 = 1 THEN 'bad_timestamp'
                  ELSE 'missing_user_id' END AS reason
      FROM ev)
SELECT reason, count(*) AS n,
       CAST(sum(CASE WHEN reason = 'malformed_json' THEN 0 ELSE COALESCE(dwell_time_ms, 0) END) AS BIGINT) AS dwell_sum
FROM r GROUP BY reason"""

SQL["q16_user_features_streamed"] = f"""
WITH {EV}, {USER_HOURLY}
SELECT * FROM uh
WHERE window_end <= (SELECT max(ts) FROM ev) - INTERVAL 30 SECOND"""

SQL["q17_divergence_report"] = f"""
WITH {EV}, {ARRIVALS},
tag AS (SELECT *, COALESCE(date_trunc('hour', ts) + INTERVAL 1 HOUR <= max_prior - INTERVAL 30 SECOND, false) AS is_late
        FROM wm),
b AS (SELECT user_id, date_trunc('hour', ts) AS window_start, count(*) AS n,
             sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS clicks,
             sum(COALESCE(dwell_time_ms, 0)) AS dwell
      FROM tag GROUP BY 1, 2),
s AS (SELECT user_id, date_trunc('hour', ts) AS window_start, count(*) AS n,
             sum(CASE WHEN lower(event_type) = 'click' THEN 1 ELSE 0 END) AS clicks,
             sum(COALESCE(dwell_time_ms, 0)) AS dwell
      FROM tag WHERE NOT is_late GROUP BY 1, 2),
l AS (SELECT user_id, date_trunc('hour', ts) AS window_start, count(*) AS late_count
      FROM tag WHERE is_late GROUP BY 1, 2),
j AS (SELECT COALESCE(b.user_id, s.user_id) AS user_id,
             COALESCE(b.window_start, s.window_start) AS window_start,
             CAST(b.clicks AS DOUBLE) / b.n AS bcr, CAST(s.clicks AS DOUBLE) / s.n AS scr,
             CAST(b.dwell AS DOUBLE) / b.n AS bdw, CAST(s.dwell AS DOUBLE) / s.n AS sdw,
             b.n AS bn, s.n AS sn
      FROM b FULL OUTER JOIN s ON b.user_id = s.user_id AND b.window_start = s.window_start)
SELECT j.user_id, j.window_start, j.window_start + INTERVAL 1 HOUR AS window_end,
       bcr AS batch_click_rate, scr AS stream_click_rate, abs(bcr - scr) AS click_rate_delta,
       bdw AS batch_avg_dwell_time, sdw AS stream_avg_dwell_time, abs(bdw - sdw) AS avg_dwell_delta,
       bn AS batch_event_count, COALESCE(sn, 0) AS stream_event_count,
       CAST(COALESCE(l.late_count, 0) AS BIGINT) AS late_count,
       CASE WHEN sn IS NULL THEN 'all_events_late'
            WHEN bcr = scr AND bdw = sdw THEN 'match'
            WHEN bn > sn THEN 'late_events_excluded'
            ELSE 'case_rule' END AS reason
FROM j LEFT JOIN l ON j.user_id = l.user_id AND j.window_start = l.window_start"""

METRIC_ROWS = f"""{EV}, {ARRIVALS},
keyed AS (SELECT *, CAST(epoch_us(arrival_ts) AS HUGEINT) * 1000000000 + event_id AS akey FROM arr),
late_ev AS (SELECT * FROM wm WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= max_prior - INTERVAL 30 SECOND),
wins AS (SELECT DISTINCT user_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end FROM ev),
ends AS (SELECT DISTINCT window_end FROM wins),
fire AS (SELECT e.window_end, min(k.akey) AS fkey
         FROM ends e JOIN keyed k ON k.ts >= e.window_end + INTERVAL 30 SECOND
         GROUP BY e.window_end),
fire_ev AS (SELECT f.window_end, k.arrival_ts AS f_arrival, k.event_id AS f_event
            FROM fire f JOIN keyed k ON k.akey = f.fkey),
rows AS (
  SELECT arrival_ts AS o_a, event_id AS o_e, CAST(NULL AS TIMESTAMP) AS o_w, CAST(NULL AS VARCHAR) AS o_u, 0 AS o_f,
         'late_event_dropped' AS metric_type, user_id AS dropped_user_id, ts AS dropped_event_ts,
         arrival_ts AS recorded_at, CAST(NULL AS TIMESTAMP) AS feature_computed_at, 1 AS w
  FROM late_ev
  UNION ALL
  SELECT fe.f_arrival, fe.f_event, w.window_end, w.user_id, f.i,
         'watermark_heartbeat', NULL, NULL, NULL, w.window_end + INTERVAL 30 SECOND, 0
  FROM wins w JOIN fire_ev fe ON w.window_end = fe.window_end
       CROSS JOIN (SELECT unnest([1, 2]) AS i) f),
ranked AS (
  SELECT *, sum(w) OVER o AS late_so_far, row_number() OVER o AS metric_offset
  FROM rows
  WINDOW o AS (ORDER BY o_a, o_e, o_w NULLS FIRST, o_u NULLS FIRST, o_f ROWS UNBOUNDED PRECEDING))"""

SQL["q22_metric_rows"] = f"""
WITH {METRIC_ROWS}
SELECT CAST(metric_offset AS BIGINT) AS metric_offset, metric_type,
       CAST(late_so_far AS BIGINT) AS running_late_count,
       dropped_user_id, dropped_event_ts, recorded_at, feature_computed_at
FROM ranked"""

SQL["q19_metrics_state"] = f"""
WITH {METRIC_ROWS},
last_beat AS (SELECT feature_computed_at FROM ranked WHERE metric_type = 'watermark_heartbeat'
              ORDER BY metric_offset DESC LIMIT 1),
last_row AS (SELECT CAST(late_so_far AS BIGINT) AS v FROM ranked ORDER BY metric_offset DESC LIMIT 1)
SELECT (SELECT v FROM last_row) AS late_events_dropped,
       (SELECT feature_computed_at FROM last_beat) AS last_watermark_time,
       CAST(epoch_ms(TIMESTAMP '2024-01-31 00:15:00') - epoch_ms((SELECT feature_computed_at FROM last_beat)) AS BIGINT) AS watermark_lag_ms,
       epoch_ms(TIMESTAMP '2024-01-31 00:15:00') - epoch_ms((SELECT feature_computed_at FROM last_beat)) > 60000 AS lag_warning,
       (SELECT count(*) FROM ranked WHERE metric_type = 'watermark_heartbeat') AS heartbeat_count,
       (SELECT count(*) FROM ranked WHERE metric_type = 'late_event_dropped') AS late_metric_count"""

SQL["q23_late_audit_streamed"] = f"""
WITH {EV},
arr AS (SELECT *, CASE WHEN event_id % 20 = 0 THEN ts + INTERVAL 3 HOUR ELSE ts END AS arrival_ts FROM ev),
bounds AS (SELECT min(epoch_us(arrival_ts)) AS lo,
                  max(epoch_us(arrival_ts)) - min(epoch_us(arrival_ts)) + 1 AS span FROM arr),
cuts AS (SELECT i, lo + CAST(ceil(i * span / 8.0) AS BIGINT) AS c
         FROM bounds, (SELECT unnest(range(0, 9)) AS i)),
sliced AS (SELECT a.*, (SELECT max(i) FROM cuts WHERE c <= epoch_us(a.arrival_ts)) AS f FROM arr a),
per_file AS (SELECT f, max(ts) AS mx FROM sliced GROUP BY f),
wm AS (SELECT f, max(mx) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
       FROM per_file)
SELECT s.user_id, s.content_id, s.event_type, s.ts,
       date_trunc('hour', s.ts) AS window_start,
       date_trunc('hour', s.ts) + INTERVAL 1 HOUR AS window_end
FROM sliced s JOIN wm ON s.f = wm.f
WHERE date_trunc('hour', s.ts) + INTERVAL 1 HOUR <= wm.prev_max - INTERVAL 30 SECOND"""

SLICED = f"""{EV},
arr AS (SELECT *, CASE WHEN event_id % 20 = 0 THEN ts + INTERVAL 3 HOUR ELSE ts END AS arrival_ts FROM ev),
bounds AS (SELECT min(epoch_us(arrival_ts)) AS lo,
                  max(epoch_us(arrival_ts)) - min(epoch_us(arrival_ts)) + 1 AS span FROM arr),
cuts AS (SELECT i, lo + CAST(ceil(i * span / 8.0) AS BIGINT) AS c
         FROM bounds, (SELECT unnest(range(0, 9)) AS i)),
sliced AS (SELECT a.*, (SELECT max(i) FROM cuts WHERE c <= epoch_us(a.arrival_ts)) AS f FROM arr a),
per_file AS (SELECT f, max(ts) AS mx FROM sliced GROUP BY f),
wm AS (SELECT f, max(mx) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
       FROM per_file),
seen AS (SELECT s.*, wm.prev_max - INTERVAL 30 SECOND AS mark FROM sliced s JOIN wm ON s.f = wm.f),
done AS (SELECT max(ts) - INTERVAL 30 SECOND AS mark FROM ev)"""

SQL["q24_user_features_out_of_order"] = f"""
WITH {SLICED},
kept AS (SELECT *, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end FROM seen
         WHERE mark IS NULL OR date_trunc('hour', ts) + INTERVAL 1 HOUR > mark)
SELECT user_id, window_end - INTERVAL 1 HOUR AS window_start, window_end,
       CAST(SUM(CASE WHEN lower(event_type) = 'click' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS click_rate,
       CAST(SUM(COALESCE(dwell_time_ms, 0)) AS DOUBLE) / COUNT(*) AS avg_dwell_time, COUNT(*) AS event_count
FROM kept WHERE window_end <= (SELECT mark FROM done) GROUP BY user_id, window_end"""

SQL["q25_content_engagement_out_of_order"] = f"""
WITH {SLICED},
opened AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) - i * INTERVAL 5 MINUTE AS window_start
           FROM (SELECT *, unnest([0, 1, 2]) AS i FROM seen)),
kept AS (SELECT *, window_start + INTERVAL 15 MINUTE AS window_end FROM opened
         WHERE mark IS NULL OR window_start + INTERVAL 15 MINUTE > mark),
c AS (SELECT content_id, window_start, window_end,
             SUM(CASE WHEN lower(event_type) = 'view' THEN 1 ELSE 0 END) AS view_count,
             SUM(CASE WHEN lower(event_type) IN ('purchase', 'signup') THEN 1 ELSE 0 END) AS engagement_count,
             COUNT(*) AS event_count
      FROM kept WHERE window_end <= (SELECT mark FROM done) GROUP BY 1, 2, 3)
SELECT content_id, window_start, window_end,
       CASE WHEN view_count > 0 THEN CAST(engagement_count AS DOUBLE) / view_count ELSE 0.0 END AS engagement_rate,
       CAST(view_count AS BIGINT) AS view_count, CAST(engagement_count AS BIGINT) AS engagement_count, event_count
FROM c"""

SQL["q26_stream_metrics_fold"] = f"""
WITH {SLICED},
late AS (SELECT * FROM seen WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark)
SELECT (SELECT count(*) FROM late) AS late_events_dropped, (SELECT count(DISTINCT f) FROM sliced) AS heartbeat_count,
       (SELECT count(*) FROM late) AS late_metric_count"""

SQL["q27_latest_table_lookup"] = f"""
WITH {EV}, {USER_HOURLY},
w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY window_end DESC) AS k FROM uh
      WHERE window_end <= (SELECT max(ts) FROM ev) - INTERVAL 30 SECOND AND user_id = '2')
SELECT user_id AS entity_id, 'click_rate' AS feature_name, click_rate AS feature_value, window_start, window_end,
       window_end + INTERVAL 30 SECOND AS computed_at FROM w WHERE k = 1
UNION ALL
SELECT user_id, 'avg_dwell_time', avg_dwell_time, window_start, window_end, window_end + INTERVAL 30 SECOND FROM w WHERE k = 1"""

SQL["q28_quarantine_streamed"] = """
SELECT CASE WHEN (event_id // 50) % 3 = 0 THEN 'malformed_json' WHEN (event_id // 50) % 3 = 1 THEN 'bad_timestamp'
            ELSE 'missing_user_id' END AS reason, count(*) AS n
FROM events WHERE event_id % 50 = 0 GROUP BY 1"""

SQL["q29_affinity_streamed"] = f"""
WITH {EV}, {META}, {AFFINITY_STREAM}
SELECT * FROM af WHERE window_end <= (SELECT max(ts) FROM ev) - INTERVAL 30 SECOND"""

SQL["q30_batch_against_stream"] = f"""
WITH {SLICED}, {META},
hours AS (SELECT *, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end FROM seen),
quarters AS (SELECT *, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
                    time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end FROM seen),
u AS (SELECT user_id AS entity_id, window_start, window_end,
             CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS b_click,
             CAST(sum(coalesce(dwell_time_ms, 0)) AS DOUBLE) / count(*) AS b_dwell, count(*) AS bn,
             count(*) FILTER (WHERE mark IS NULL OR window_end > mark) AS sn,
             CAST(sum(CASE WHEN lower(event_type) = 'click' THEN 1 ELSE 0 END) FILTER (WHERE mark IS NULL OR window_end > mark) AS DOUBLE) AS s_clicks,
             CAST(sum(coalesce(dwell_time_ms, 0)) FILTER (WHERE mark IS NULL OR window_end > mark) AS DOUBLE) AS s_dwell
      FROM hours GROUP BY 1, 2, 3),
c AS (SELECT content_id AS entity_id, window_start, window_end, count(*) AS bn,
             count(*) FILTER (WHERE mark IS NULL OR window_end > mark) AS sn,
             sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS bv,
             sum(CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END) AS be,
             sum(CASE WHEN lower(event_type) = 'view' THEN 1 ELSE 0 END) FILTER (WHERE mark IS NULL OR window_end > mark) AS sv,
             sum(CASE WHEN lower(event_type) IN ('purchase', 'signup') THEN 1 ELSE 0 END) FILTER (WHERE mark IS NULL OR window_end > mark) AS se
      FROM quarters GROUP BY 1, 2, 3),
a AS (SELECT h.user_id AS entity_id, 'category_affinity_' || coalesce(m.category, 'unknown') AS feature_name, window_start, window_end,
             count(*) AS bn, count(*) FILTER (WHERE m.category IS NOT NULL AND (mark IS NULL OR window_end > mark)) AS sn
      FROM hours h LEFT JOIN meta m ON h.content_id = m.content_id GROUP BY 1, 2, 3, 4),
every AS (
  SELECT entity_id, 'click_rate' AS feature_name, window_start, window_end, b_click AS batch_value, s_clicks / sn AS stream_value, bn, sn FROM u
  UNION ALL SELECT entity_id, 'avg_dwell_time', window_start, window_end, b_dwell, s_dwell / sn, bn, sn FROM u
  UNION ALL SELECT entity_id, 'engagement_rate', window_start, window_end,
                   CASE WHEN bv > 0 THEN CAST(be AS DOUBLE) / bv ELSE 0.0 END,
                   CASE WHEN sv > 0 THEN CAST(se AS DOUBLE) / sv ELSE 0.0 END, bn, sn FROM c
  UNION ALL SELECT entity_id, feature_name, window_start, window_end, CAST(bn AS DOUBLE), CAST(sn AS DOUBLE), bn, sn FROM a),
shown AS (SELECT entity_id, feature_name, window_start, window_end, batch_value,
                 CASE WHEN sn > 0 AND window_end <= (SELECT mark FROM done) THEN stream_value END AS stream_value,
                 window_end > (SELECT mark FROM done) AS still_open, bn, sn FROM every)
SELECT entity_id, feature_name, window_start, window_end, batch_value, stream_value, abs(batch_value - stream_value) AS delta,
       CASE WHEN batch_value = stream_value THEN 'match' WHEN still_open THEN 'open_window'
            WHEN feature_name = 'category_affinity_unknown' THEN 'content_without_metadata'
            WHEN stream_value IS NULL THEN 'all_events_late' WHEN sn < bn THEN 'late_events_excluded' ELSE 'case_rule' END AS reason
FROM shown"""

SQL["q31_first_events"] = f"""
WITH {EV}, {ARRIVALS}
SELECT event_id, user_id, content_id, event_type, ts, arrival_ts FROM arr ORDER BY arrival_ts, event_id LIMIT 5000"""

SQL["q32_top_user_rows"] = f"""
WITH {EV}
SELECT user_id, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS click_rate,
       CAST(SUM(COALESCE(dwell_time_ms, 0)) AS DOUBLE) / COUNT(*) AS avg_dwell_time, COUNT(*) AS event_count
FROM ev GROUP BY 1, 2, 3 ORDER BY 1, 2 LIMIT 20"""

SQL["q33_entities_with_feature"] = f"""
WITH {ALL_FEATURES}, {LATEST}
SELECT DISTINCT entity_id, 'engagement_rate' AS feature_name, CAST(NULL AS VARCHAR) AS served FROM latest WHERE feature_name = 'engagement_rate'
UNION ALL
SELECT entity_id, feature_name, CAST(CAST(feature_value AS BIGINT) AS VARCHAR) FROM latest WHERE feature_name LIKE 'category_affinity_%'"""


def _family_windows() -> str:
    """Closed windows of the three families under the replay's watermarks, and the late entries of each."""
    sums = """CAST(sum(CASE WHEN lower(event_type) = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
             CAST(sum(CASE WHEN lower(event_type) = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
             CAST(sum(CASE WHEN lower(event_type) IN ('purchase', 'signup') THEN 1 ELSE 0 END) AS BIGINT) AS engagements,
             CAST(sum(coalesce(dwell_time_ms, 0)) AS BIGINT) AS dwell_sum, count(*) AS event_count"""
    return f"""{SLICED}, {META},
hours AS (SELECT s.*, date_trunc('hour', s.ts) AS window_start, date_trunc('hour', s.ts) + INTERVAL 1 HOUR AS window_end, m.category
          FROM seen s LEFT JOIN meta m ON s.content_id = m.content_id),
fives AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) - i * INTERVAL 5 MINUTE AS window_start,
                 time_bucket(INTERVAL 5 MINUTE, ts) - i * INTERVAL 5 MINUTE + INTERVAL 15 MINUTE AS window_end
          FROM (SELECT *, unnest([0, 1, 2]) AS i FROM seen)),
entry AS (SELECT 'user' AS family, user_id AS entity_id, CAST(NULL AS VARCHAR) AS category, window_start, window_end, 0 AS i,
                 mark, f, ts, user_id, content_id, event_type, dwell_time_ms FROM hours
          UNION ALL SELECT 'affinity', user_id, category, window_start, window_end, 0, mark, f, ts, user_id, content_id, event_type, dwell_time_ms
          FROM hours WHERE category IS NOT NULL
          UNION ALL SELECT 'content', content_id, NULL, window_start, window_end, i, mark, f, ts, user_id, content_id, event_type, dwell_time_ms FROM fives),
windows AS (SELECT family, entity_id, category, window_start, window_end, {sums} FROM entry
            WHERE (mark IS NULL OR window_end > mark) AND window_end <= (SELECT mark FROM done) GROUP BY ALL),
late AS (SELECT * FROM entry WHERE i = 0 AND window_end <= mark)"""


FAMILY_WINDOWS = _family_windows()

SQL["q34_windows_and_late_events"] = f"""
WITH {FAMILY_WINDOWS}
SELECT 'window' AS kind, family, entity_id, category, window_start, window_end, clicks, views, engagements, dwell_sum, event_count,
       CAST(NULL AS TIMESTAMP) AS ts, CAST(NULL AS VARCHAR) AS content_id, CAST(NULL AS VARCHAR) AS event_type FROM windows
UNION ALL
SELECT 'late', family, entity_id, category, window_start, window_end, NULL, NULL, NULL, NULL, 1, ts, content_id, event_type FROM late"""

SQL["q35_feature_records"] = f"""
WITH {FAMILY_WINDOWS},
feature AS (
  SELECT entity_id, 'click_rate' AS feature_name, CAST(clicks AS DOUBLE) / event_count AS feature_value, false AS is_whole FROM windows WHERE family = 'user'
  UNION ALL SELECT entity_id, 'avg_dwell_time', CAST(dwell_sum AS DOUBLE) / event_count, false FROM windows WHERE family = 'user'
  UNION ALL SELECT entity_id, 'engagement_rate', CASE WHEN views > 0 THEN CAST(engagements AS DOUBLE) / views ELSE 0.0 END, false
            FROM windows WHERE family = 'content'
  UNION ALL SELECT entity_id, 'category_affinity_' || category, CAST(event_count AS DOUBLE), true FROM windows WHERE family = 'affinity')
SELECT entity_id || '|' || feature_name AS key, entity_id, feature_name, feature_value, is_whole, true AS emitted_here FROM feature"""

SQL["q36_stream_metric_rows"] = f"""
WITH {FAMILY_WINDOWS},
marks AS (SELECT f, prev_max - INTERVAL 30 SECOND AS mark FROM wm UNION ALL SELECT 8, mark FROM done),
beat AS (SELECT w.entity_id, w.window_end, n.i, (SELECT min(f) FROM marks WHERE marks.mark >= w.window_end) AS f
         FROM windows w, (SELECT unnest([0, 1]) AS i) n WHERE family = 'user'),
rows AS (SELECT f, 0 AS k, epoch_us(ts) AS t, user_id AS u, coalesce(content_id, '') AS m, event_type AS l, 1 AS w, ts FROM late WHERE family = 'user'
         UNION ALL SELECT f, 1, epoch_us(window_end), entity_id, CAST(i AS VARCHAR), '', 0, NULL FROM beat),
ranked AS (SELECT *, row_number() OVER o AS metric_offset, sum(w) OVER o AS late_so_far FROM rows
           WINDOW o AS (ORDER BY f, k, t, u, m, l ROWS UNBOUNDED PRECEDING))
SELECT metric_offset, CASE WHEN k = 0 THEN 'late_event_dropped' ELSE 'watermark_heartbeat' END AS metric_type,
       CAST(late_so_far AS BIGINT) AS running_late_count, CASE WHEN k = 0 THEN u END AS dropped_user_id, ts AS dropped_event_ts
FROM ranked"""

LATENESS = f"""{EV}, {META}, {ARRIVALS},
l AS (
  SELECT 'user' AS window_family, m.category IS NOT NULL AS has_category,
         epoch_us(w.max_prior) - epoch_us(date_trunc('hour', w.ts) + INTERVAL 1 HOUR) AS us
  FROM wm w LEFT JOIN meta m ON w.content_id = m.content_id
  UNION ALL
  SELECT 'content', m.category IS NOT NULL,
         epoch_us(w.max_prior) - epoch_us(time_bucket(INTERVAL 5 MINUTE, w.ts) + INTERVAL 15 MINUTE)
  FROM wm w LEFT JOIN meta m ON w.content_id = m.content_id)"""

SQL["q37_lateness_histogram"] = f"""
WITH {LATENESS}
SELECT window_family, us // 1000000 AS lateness_s, count(*) AS n FROM l WHERE us >= 0 GROUP BY ALL"""

SQL["q38_late_counts_any_delay"] = f"""
WITH {LATENESS},
d AS (SELECT unnest([0, 30, 120, 600, 3600, 7200, 9000]) AS delay_s),
f AS (SELECT window_family, us FROM l UNION ALL SELECT 'affinity', us FROM l WHERE window_family = 'user' AND has_category)
SELECT f.window_family, CAST(d.delay_s AS INTEGER) AS delay_s,
       CAST(count(*) FILTER (WHERE f.us >= d.delay_s * CAST(1000000 AS BIGINT)) AS BIGINT) AS late_count
FROM f CROSS JOIN d GROUP BY ALL"""

SERVED = f"""{EV}, {USER_HOURLY}, {CONTENT_SLIDING},
closed AS (SELECT max(ts) - INTERVAL 30 SECOND AS until FROM ev),
latest AS (
  SELECT user_id AS entity_id, unnest(['click_rate', 'avg_dwell_time']) AS feature_name, max(window_end) + INTERVAL 30 SECOND AS computed_at
  FROM uh, closed WHERE window_end <= until AND user_id IS NOT NULL GROUP BY user_id
  UNION ALL
  SELECT content_id, 'engagement_rate', max(window_end) + INTERVAL 30 SECOND
  FROM cs, closed WHERE window_end <= until AND content_id IS NOT NULL GROUP BY content_id)"""

SQL["q39_entities_from_index"] = f"""
WITH {SERVED}
SELECT entity_id, feature_name FROM latest WHERE feature_name IN ('click_rate', 'engagement_rate')"""

SQL["q40_freshness_from_summary"] = f"""
WITH {SERVED},
j AS (SELECT feature_name, count(*) AS entity_count, max(computed_at) AS last_computed_at,
             CAST(epoch_ms(TIMESTAMP '2024-01-31 00:15:00') - epoch_ms(max(computed_at)) AS BIGINT) AS age_ms
      FROM latest GROUP BY feature_name)
SELECT feature_name, entity_count, last_computed_at, age_ms,
       greatest(0.0, 100.0 - CAST(age_ms AS DOUBLE) / 300000.0 * 100.0) AS freshness_pct,
       {_duration_sql('age_ms')} AS age_text
FROM j"""

SQL["q41_stream_progress"] = f"""
WITH {SLICED}
SELECT 'watermark_lag' AS metric_type, CAST(row_number() OVER (ORDER BY f) - 1 AS BIGINT) AS batch_id,
       date_trunc('millisecond', min(mark)) AS watermark, count(*) AS input_rows
FROM seen GROUP BY f"""

SQL["q42_profile_from_sketches"] = f"""
WITH {EV}
SELECT count(*) AS event_count, min(ts) AS min_ts, max(ts) AS max_ts, true AS users_within, true AS contents_within FROM ev"""
