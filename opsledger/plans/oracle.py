"""Each registered query as SQL over the same tables, written from its meaning."""

# The views of ``views.py``; a later one may use an earlier one.
_VIEWS = {
    "fx_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS customer_id,
               (SELECT CAST(min(l_partkey) AS VARCHAR) FROM lineitem
                WHERE l_orderkey = o_orderkey) AS product_id,
               (SELECT CAST(sum(l_quantity) AS INTEGER) FROM lineitem
                WHERE l_orderkey = o_orderkey) AS quantity,
               CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'confirmed'
                    WHEN 'P' THEN 'cancelled' ELSE o_orderstatus END AS status,
               o_orderdate AS created_at
        FROM orders""",
    "fx_order_requests": """
        SELECT CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
               CASE WHEN l_partkey % 100 = 0 THEN 'x'
                    ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
               CASE WHEN l_partkey % 3 = 0 THEN NULL
                    ELSE CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'confirmed'
                              WHEN 'P' THEN 'cancelled' ELSE o_orderstatus END END AS status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_events": """
        SELECT event_id, ts,
               CASE event_type WHEN 'purchase' THEN 'order.created' WHEN 'signup' THEN 'order.confirmed'
                    WHEN 'error' THEN 'order.cancelled' WHEN 'click' THEN 'order.shipped'
                    WHEN 'view' THEN 'order.viewed' ELSE event_type END AS event_type,
               CAST(event_id * 2 AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id
        FROM events""",
    "fx_messages": """
        SELECT event_id, ts,
               CASE event_id % 50
                    WHEN 0 THEN 'not json {'
                    WHEN 1 THEN '[1]'
                    WHEN 2 THEN CAST(json_object('payload', payload) AS VARCHAR)
                    WHEN 3 THEN CAST(json_object('event_type', NULL, 'payload', payload) AS VARCHAR)
                    WHEN 4 THEN chr(9) || CAST(json_object('event_type', event_type, 'payload', payload)
                                               AS VARCHAR) || ' ' || chr(10)
                    WHEN 5 THEN '{''event_type'':''order.created''}'
                    WHEN 6 THEN '{"event_type":"order.created","payload":[1]}'
                    WHEN 7 THEN '{"event_type":"order.created","payload":"{}"}'
                    ELSE CAST(json_object('event_type', event_type, 'payload', payload) AS VARCHAR)
               END AS body
        FROM (SELECT *, json_object('order_id', order_id, 'customer_id', customer_id) AS payload
              FROM fx_events)""",
    "fx_decoded": """
        SELECT event_id, ts, body,
               json_valid(body) AND json_type(TRY_CAST(body AS JSON)) = 'OBJECT'
                   AND coalesce(json_type(TRY_CAST(body AS JSON), '$.payload'), 'NULL')
                       IN ('NULL', 'OBJECT') AS good,
               coalesce(TRY_CAST(body AS JSON) ->> '$.event_type', 'unknown') AS event_type,
               TRY_CAST(body AS JSON) ->> '$.payload.order_id' AS order_id,
               TRY_CAST(body AS JSON) ->> '$.payload.customer_id' AS customer_id
        FROM fx_messages""",
    "fx_redelivered": """
        SELECT * FROM fx_events UNION ALL SELECT * FROM fx_events WHERE event_id % 10 = 0""",
    "fx_rules": """
        SELECT * FROM (VALUES
            ('order.created', 0, 'email', 'order_confirmation', 3, NULL),
            ('order.created', 1, 'push', 'order_created_push', 1, NULL),
            ('order.confirmed', 0, 'email', 'order_confirmed', 3, NULL),
            ('order.confirmed', 1, 'push', 'order_confirmed_push', 1, NULL),
            ('order.cancelled', 0, 'email', 'order_cancellation', 3, NULL),
            ('order.shipped', 0, 'email', 'order_shipped', 3, NULL),
            ('order.shipped', 1, 'sms', 'order_shipped_sms', 2, NULL),
            ('default', 0, 'log', '', NULL, 'warning')
        ) r(rule, pos, channel, template, retry, level)""",
    "fx_attempts": """
        SELECT e.*, r.pos, r.channel, r.template, r.retry, r.level,
               CAST(e.event_id % 5 + 1 AS INTEGER) AS attempts_needed,
               e.event_id % 5 + 1 <= 1 + coalesce(r.retry, 0) AS delivered
        FROM fx_events e JOIN fx_rules r
          ON r.rule = CASE WHEN e.event_type IN (SELECT rule FROM fx_rules) THEN e.event_type
                           ELSE 'default' END""",
    "fx_requests": """
        SELECT ts, 'svc-' || (user_id % 5) AS job,
               CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
               CASE WHEN event_type = 'purchase' THEN '/orders' ELSE '/orders/{id}' END AS path,
               CASE event_type WHEN 'error' THEN '500' WHEN 'purchase' THEN '201' ELSE '200' END
                   AS status_code,
               value / 100 AS duration_seconds
        FROM events""",
    "fx_weighted": """
        SELECT ts, 'svc-' || (user_id % 5) AS job, value / 100 AS v,
               1 + (event_id % 7) * 1500000000 AS w
        FROM events""",
    "fx_published": """
        SELECT ts, job, 'created' AS kind FROM fx_requests WHERE method = 'POST'
        UNION ALL
        SELECT ts, job, 'published' FROM fx_requests
        WHERE method = 'POST' AND job <> 'svc-0' AND duration_seconds <= 1""",
    "fx_counter": """
        SELECT ts, job, status_code, CAST(so_far AS DOUBLE) AS value
        FROM (SELECT ts, job, status_code,
                     count(*) OVER (PARTITION BY job, status_code, CAST(ts AS DATE) ORDER BY ts)
                         AS so_far,
                     lead(ts) OVER (PARTITION BY job, status_code ORDER BY ts) AS next_ts
              FROM fx_requests)
        WHERE next_ts IS NULL OR date_trunc('hour', next_ts) <> date_trunc('hour', ts)""",
    "fx_scrape_mixed": """
        SELECT *, value % 11 = 0 AS broken, value % 13 = 0 AS doubled,
               CASE WHEN value % 7 = 0 THEN date_trunc('milliseconds', ts) + INTERVAL 1 MINUTE ELSE ts END
                   AS own_ts
        FROM fx_counter""",
    "fx_gauge": """
        SELECT ts, 'svc-' || (user_id % 5) AS job, 'pod-' || (user_id % 15) AS pod, m.metric,
               CASE m.metric
                    WHEN 'job_failed' THEN CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END
                    WHEN 'volume_available' THEN value
                    WHEN 'volume_capacity' THEN 500.0
                    WHEN 'cpu_usage' THEN value
                    ELSE CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END END::DOUBLE AS value
        FROM events, (VALUES ('up'), ('pod_ready'), ('job_failed'), ('volume_available'),
                             ('volume_capacity'), ('cpu_usage')) m(metric)""",
    "fx_pods": """
        SELECT CAST(n_nationkey AS VARCHAR) AS uid, r_name AS namespace, n_name AS pod,
               'app' AS container, 'svc-' || (n_nationkey % 5) AS app,
               CASE WHEN n_nationkey % 7 = 0 THEN 'Failed' ELSE 'Running' END AS phase
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "fx_logs": """
        SELECT ts, CAST(user_id % 25 AS VARCHAR) AS uid, event_type,
               CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
               CASE event_type WHEN 'error' THEN 'upstream timeout' WHEN 'view' THEN 'GET /health'
                    WHEN 'purchase' THEN 'order created' ELSE 'request completed' END AS message,
               CASE event_type WHEN 'error' THEN 500 WHEN 'purchase' THEN 201 ELSE 200 END
                   AS status_code,
               value / 100 AS duration_seconds,
               CAST(event_id AS VARCHAR) AS trace_id,
               '/var/log/pods/' || (user_id % 25) || '/app/0.log' AS path,
               '{"time":"' || strftime(ts, '%Y-%m-%d %H:%M:%S,%g') || '","level":"'
                   || level || '","name":"src.main","message":"' || message
                   || '","status_code":' || status_code || ',"duration_seconds":'
                   || CAST(value / 100 AS DECIMAL(18, 4)) || ',"trace_id":"' || event_id || '"}' AS line
        FROM events""",
    "fx_enriched": """
        SELECT l.*, p.namespace, p.pod, p.container, p.app
        FROM fx_logs l JOIN fx_pods p ON l.uid = p.uid AND p.container = 'app'
        WHERE p.phase NOT IN ('Pending', 'Succeeded', 'Failed', 'Completed')""",
    # One row per evaluation time that some event falls in the window of.
    "grid": """
        SELECT g AS window_end, g - INTERVAL 6 HOUR AS window_start
        FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)) + INTERVAL 1 HOUR,
                                            date_trunc('hour', max(ts)) + INTERVAL 6 HOUR,
                                            INTERVAL 1 HOUR)) AS g FROM events)""",
    "w_requests": """
        SELECT window_start, window_end, r.* FROM fx_requests r
        JOIN grid ON ts >= window_start AND ts < window_end""",
    "s_error_ratio": """
        SELECT job, window_start, window_end,
               CAST(count(*) FILTER (status_code LIKE '5__') AS BIGINT) AS n_part,
               count(*) AS n_all,
               count(*) FILTER (status_code LIKE '5__') / count(*)::DOUBLE AS ratio
        FROM w_requests GROUP BY ALL""",
    "bounds": """
        SELECT * FROM (VALUES (0.005), (0.01), (0.025), (0.05), (0.1), (0.25), (0.5), (1.0), (2.5),
                              (5.0), (10.0), ('Infinity'::DOUBLE)) b(le)""",
    "w_buckets": """
        SELECT job, window_start, window_end, le,
               count(*) FILTER (duration_seconds <= le) AS cum,
               count(*) AS total
        FROM w_requests, bounds GROUP BY ALL""",
    "s_quantile": """
        SELECT job, window_start, window_end,
               CASE WHEN le = 'Infinity'::DOUBLE THEN 10.0
                    ELSE low + (le - low) * ((0.95::DOUBLE * total - below) / (cum - below)) END
                   AS quantile
        FROM (SELECT *, lag(le, 1, 0.0) OVER w AS low, lag(cum, 1, 0) OVER w AS below
              FROM w_buckets WINDOW w AS (PARTITION BY job, window_end ORDER BY le))
        WHERE cum >= 0.95::DOUBLE * total AND below < 0.95::DOUBLE * total""",
    "s_publishing": """
        SELECT job, window_start, window_end,
               count(*) FILTER (kind = 'created') AS created,
               count(*) FILTER (kind = 'published') AS published
        FROM fx_published JOIN grid ON ts >= window_start AND ts < window_end GROUP BY ALL""",
    "s_increase": """
        SELECT job, status_code, window_start, window_end,
               CAST(sum(CASE WHEN value < prev THEN value ELSE value - prev END) AS DOUBLE) AS increase
        FROM (SELECT *, lag(value) OVER (PARTITION BY job, status_code, window_end ORDER BY ts) AS prev
              FROM fx_counter JOIN grid ON ts >= window_start AND ts < window_end)
        GROUP BY ALL HAVING count(*) >= 2""",
    "s_latest": """
        SELECT metric, job, window_start, window_end, arg_max(value, ts) AS value, max(ts) AS sample_ts
        FROM fx_gauge JOIN grid ON ts >= window_start AND ts < window_end GROUP BY ALL""",
    "s_volume": """
        SELECT a.job, a.window_start, a.window_end, a.value AS numerator, c.value AS denominator,
               a.value / nullif(c.value, 0) AS ratio
        FROM s_latest a JOIN s_latest c USING (job, window_end)
        WHERE a.metric = 'volume_available' AND c.metric = 'volume_capacity'""",
    "evaluated_all": """
        SELECT 'HighErrorRate' AS alert, 'critical' AS severity, '{"job":"' || job || '"}' AS labels,
               window_end AS eval_ts, ratio AS value, ratio > 0.2 AS breach, 3 AS hold_h,
               'High error rate on ' || job AS summary,
               'Server errors are ' || percent_of(ratio) || ' of the requests to ' || job || '.'
                   AS description
        FROM s_error_ratio
        UNION ALL
        SELECT 'ServiceDown', 'critical', '{"job":"' || job || '"}', window_end, value, value = 0, 3,
               job || ' is down', 'The metrics of ' || job || ' cannot be read.'
        FROM s_latest WHERE metric = 'up'
        UNION ALL
        SELECT 'HighLatency', 'warning', '{"job":"' || job || '"}', window_end, quantile,
               quantile > 1.5, 3, 'High p95 latency on ' || job,
               '95% of the requests to ' || job || ' take up to ' || duration_of(quantile) || '.'
        FROM s_quantile
        UNION ALL
        SELECT 'EventPublishingFailing', 'critical', '{"job":"' || job || '"}', window_end,
               CASE WHEN published = 0 THEN created ELSE 0 END, created > 0 AND published = 0, 3,
               job || ' is creating orders but not publishing events',
               CASE WHEN published = 0 THEN created ELSE 0 END || ' orders led to no event.'
        FROM s_publishing
        UNION ALL
        SELECT 'PodCrashLooping', 'critical',
               '{"namespace":"shop","pod":"' || job || '-0","status_code":"' || status_code || '"}',
               window_end, increase, increase > 3, 3, 'shop/' || job || '-0 is crash looping',
               job || '-0 has restarted ' || CAST(increase AS BIGINT) || ' times.' FROM s_increase
        UNION ALL
        SELECT 'PodNotReady', 'warning', '{"namespace":"shop","pod":"' || job || '-0"}', window_end,
               value, value = 0, 3, 'shop/' || job || '-0 is not ready',
               job || '-0 has not been ready for some time.' FROM s_latest WHERE metric = 'pod_ready'
        UNION ALL
        SELECT 'CronJobFailed', 'warning', '{"job_name":"report-' || job || '"}', window_end, value,
               value > 0, 0, 'report-' || job || ' failed',
               'The last run of report-' || job || ' failed.'
        FROM s_latest WHERE metric = 'job_failed'
        UNION ALL
        SELECT 'PersistentVolumeFillingUp', 'warning',
               '{"persistentvolumeclaim":"data-' || job || '"}', window_end, ratio, ratio < 0.15, 3,
               'data-' || job || ' is filling up',
               percent_of(ratio) || ' of the volume data-' || job || ' is free.' FROM s_volume""",
}

_DIGITS = (
    "regexp_replace(printf('%.3f', CASE WHEN abs({v}) >= 1000 THEN round({v}, 0)"
    " WHEN abs({v}) >= 100 THEN round({v}, 1) WHEN abs({v}) >= 10 THEN round({v}, 2)"
    " ELSE round({v}, 3) END), '\\.?0+$', '')"
)
_VIEWS["evaluated_all"] = (
    _VIEWS["evaluated_all"]
    .replace("percent_of(ratio)", _DIGITS.format(v="(ratio * 100)") + " || '%'")
    .replace(
        "duration_of(quantile)",
        f"CASE WHEN quantile >= 1 THEN {_DIGITS.format(v='quantile')} || 's'"
        f" ELSE {_DIGITS.format(v='(quantile * 1000)')} || 'ms' END",
    )
)

# Each alert query with the rules that it shows.
_ALERTS = {
    "service_down": "ServiceDown",
    "high_error_rate": "HighErrorRate",
    "high_latency": "HighLatency",
    "event_publishing_failing": "EventPublishingFailing",
    "pod_crash_looping": "PodCrashLooping",
    "pod_not_ready": "PodNotReady",
    "cron_job_failed": "CronJobFailed",
    "volume_filling_up": "PersistentVolumeFillingUp",
}

# Evaluations that breach at consecutive hours share one value of (hour - rank).
_STATES = """
    SELECT e.alert, e.severity, e.labels, e.eval_ts, round(e.value, 6) AS value, i.active_since,
           CASE WHEN i.active_since IS NULL THEN 'inactive'
                WHEN e.eval_ts - i.active_since >= e.hold_h * INTERVAL 1 HOUR THEN 'firing'
                ELSE 'pending' END AS state, e.summary, e.description
    FROM {source} e LEFT JOIN (
        SELECT alert, labels, eval_ts,
               min(eval_ts) OVER (PARTITION BY alert, labels, island) AS active_since
        FROM (SELECT alert, labels, eval_ts,
                     eval_ts - INTERVAL 1 HOUR
                         * row_number() OVER (PARTITION BY alert, labels ORDER BY eval_ts) AS island
              FROM {source} WHERE breach)
    ) i ON e.alert = i.alert AND e.labels = i.labels AND e.eval_ts = i.eval_ts"""

_SUMMARY = """
    SELECT count(*) AS total_orders,
           count(*) FILTER (status = 'pending') AS pending,
           count(*) FILTER (status = 'confirmed') AS confirmed,
           count(*) FILTER (status = 'cancelled') AS cancelled,
           TIMESTAMP '1998-01-01' AS period_start, TIMESTAMP '1998-01-08' AS period_end
    FROM fx_orders
    WHERE created_at >= TIMESTAMP '1998-01-01' AND created_at < TIMESTAMP '1998-01-08'"""


def _sliding(days: int, every: int, first: str) -> str:
    """Runs every ``every`` days, counted from ``first``, over the ``days`` before.

    From the first run that holds an order to the last, with those that hold none.
    """
    return f"""
    SELECT count(id) AS total_orders,
           count(*) FILTER (status = 'pending') AS pending,
           count(*) FILTER (status = 'confirmed') AS confirmed,
           count(*) FILTER (status = 'cancelled') AS cancelled,
           run - INTERVAL {days} DAY AS period_start, run AS period_end
    FROM (SELECT unnest(generate_series(TIMESTAMP '{first}',
                 (SELECT max(o_orderdate) + INTERVAL {days + every} DAY FROM orders),
                 INTERVAL {every} DAY)) AS run)
    LEFT JOIN fx_orders ON created_at >= run - INTERVAL {days} DAY AND created_at < run
    WHERE run > (SELECT min(o_orderdate) FROM orders)
      AND run - INTERVAL {days} DAY <= (SELECT max(o_orderdate) FROM orders)
    GROUP BY run"""


_DAILY = _sliding(7, 1, "1970-01-01 06:00:00")

_LOG_COLUMNS = "ts, namespace, pod, container, app, trace_id"

_RATE = """
    SELECT {keys}, window_start, window_end, count(*) AS {n}, count(*) / 21600.0::DOUBLE AS rate
    FROM {source} JOIN grid ON ts >= window_start AND ts < window_end
    WHERE {where} GROUP BY {keys}, window_start, window_end"""

_CARDINALITY = """
        SELECT job, window_start, window_end, count(DISTINCT (method, status_code, path)) AS n_series
        FROM fx_requests JOIN grid ON ts >= window_start AND ts < window_end GROUP BY ALL"""

_QUERIES = {
    "orders_scan": "SELECT * FROM fx_orders",
    "orders_in_period": """
        SELECT * FROM fx_orders
        WHERE created_at >= TIMESTAMP '1998-01-01' AND created_at < TIMESTAMP '1998-01-08'""",
    "order_summary": _SUMMARY,
    "report_json": f"""
        SELECT '1998-01-01T00:00:00+00:00' AS period_start, '1998-01-08T00:00:00+00:00' AS period_end,
               total_orders, pending, confirmed, cancelled FROM ({_SUMMARY})""",
    "report_long": f"""
        WITH s AS ({_SUMMARY})
        SELECT 1 AS ordinal, 'period_start' AS metric, '1998-01-01T00:00:00+00:00' AS value
        UNION ALL SELECT 2, 'period_end', '1998-01-08T00:00:00+00:00'
        UNION ALL SELECT 3, 'total_orders', CAST(total_orders AS VARCHAR) FROM s
        UNION ALL SELECT 4, 'pending', CAST(pending AS VARCHAR) FROM s
        UNION ALL SELECT 5, 'confirmed', CAST(confirmed AS VARCHAR) FROM s
        UNION ALL SELECT 6, 'cancelled', CAST(cancelled AS VARCHAR) FROM s""",
    "report_sliding": _DAILY,
    "report_incremental": _DAILY,
    "report_weekly": _sliding(7, 7, "1970-01-05 06:00:00"),
    "report_shares": f"""
        WITH s AS ({_DAILY})
        SELECT period_start, period_end, 1 AS ordinal, 'pending' AS status, pending AS n_orders,
               pending / greatest(total_orders, 1)::DOUBLE * 100 AS pct FROM s
        UNION ALL SELECT period_start, period_end, 2, 'confirmed', confirmed,
               confirmed / greatest(total_orders, 1)::DOUBLE * 100 FROM s
        UNION ALL SELECT period_start, period_end, 3, 'cancelled', cancelled,
               cancelled / greatest(total_orders, 1)::DOUBLE * 100 FROM s
        UNION ALL SELECT period_start, period_end, 4, 'total', total_orders, 100.0 FROM s""",
    "report_html": f"""
        WITH s AS ({_DAILY}), r AS (
            SELECT period_start, 1 AS ordinal, 'pending' AS status, pending AS n, total_orders FROM s
            UNION ALL SELECT period_start, 2, 'confirmed', confirmed, total_orders FROM s
            UNION ALL SELECT period_start, 3, 'cancelled', cancelled, total_orders FROM s),
        t AS (
            SELECT period_start, string_agg(
                '<tr data-status="' || status || '"><th scope="row">' || status || '</th><td>' || n || '</td><td>'
                || printf('%.1f', round_even(n / greatest(total_orders, 1)::DOUBLE * 100, 1)) || '%</td>'
                || '<td><hr align="left" style="width: '
                || CAST(round_even(n / greatest(total_orders, 1)::DOUBLE * 100, 0) AS INTEGER)
                || '%"></td></tr>', '' ORDER BY ordinal) AS body
            FROM r GROUP BY period_start)
        SELECT CAST(period_start AS DATE) AS period_start_date, CAST(period_end AS DATE) AS period_end_date,
               '<!DOCTYPE html><html><head><title>Order Report ' || CAST(period_start AS DATE) || ' – '
               || CAST(period_end AS DATE) || '</title></head><body><h1>Order Summary Report</h1><p>Period: '
               || CAST(period_start AS DATE) || ' – ' || CAST(period_end AS DATE) || ' | Generated: '
               || strftime(period_end, '%Y-%m-%d %H:%M UTC') || '</p><table>'
               || '<tr><th>Status</th><th>Count</th><th>Share</th><th></th></tr>' || body
               || '<tr><th scope="row">Total</th><td>' || total_orders
               || '</td><td>100%</td><td></td></tr></table></body></html>' AS html
        FROM s JOIN t USING (period_start)""",
    "orders_lookup": """
        SELECT id, status IS NOT NULL AS found, status, customer_id
        FROM (SELECT DISTINCT CAST(c_custkey * 20 AS VARCHAR) AS id FROM customer)
        LEFT JOIN (SELECT id, status, customer_id FROM fx_orders) USING (id)""",
    "orders_ingest_valid": """
        SELECT customer_id, product_id, TRY_CAST(quantity AS INTEGER) AS quantity, status,
               quantity <> 'x' AS accepted,
               CASE WHEN quantity = 'x' THEN 'quantity not an integer' END AS reason
        FROM fx_order_requests""",
    "orders_rejected": """
        SELECT customer_id, product_id, quantity, status, 'quantity not an integer' AS reason
        FROM fx_order_requests WHERE quantity = 'x'""",
    "orders_append": """
        SELECT customer_id, product_id, CAST(quantity AS INTEGER) AS quantity,
               coalesce(status, 'pending') AS status
        FROM fx_order_requests WHERE quantity <> 'x'""",
    "scalar_formats": """
        WITH m AS (SELECT *, created_at + quantity * INTERVAL 125 MILLISECOND AS t FROM fx_orders)
        SELECT id,
               CASE WHEN quantity % 8 = 0 THEN strftime(t, '%Y-%m-%dT%H:%M:%S')
                    ELSE strftime(t, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00' AS iso,
               CAST(t AS DATE) AS day, strftime(t, '%Y-%m-%d %H:%M') || ' UTC' AS minute,
               created_at - INTERVAL 7 DAY AS week_before,
               CAST(round_even(quantity * 0.5::DOUBLE, 0) AS INTEGER) AS bar,
               round_even(quantity / 7.0::DOUBLE, 4) AS rounded
        FROM m""",
    "dq_not_null": """
        WITH o AS (SELECT * FROM fx_orders)
        SELECT 'id' AS column_name, count(*) FILTER (id IS NULL) AS null_count FROM o
        UNION ALL SELECT 'customer_id', count(*) FILTER (customer_id IS NULL) FROM o
        UNION ALL SELECT 'product_id', count(*) FILTER (product_id IS NULL) FROM o
        UNION ALL SELECT 'quantity', count(*) FILTER (quantity IS NULL) FROM o
        UNION ALL SELECT 'status', count(*) FILTER (status IS NULL) FROM o
        UNION ALL SELECT 'created_at', count(*) FILTER (created_at IS NULL) FROM o""",
    "dq_unique": """
        SELECT count(*) AS total_rows, count(DISTINCT o_orderkey) AS distinct_keys,
               (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))
                   AS duplicated_keys,
               count(*) - count(DISTINCT o_orderkey) AS surplus_rows
        FROM orders""",
    "dq_duplicates": """
        SELECT event_id, count(*) AS copies FROM fx_redelivered GROUP BY 1 HAVING count(*) > 1""",
    "dq_status_domain": """
        SELECT status, count(*) AS n_rows, status IN ('pending', 'confirmed', 'cancelled') AS allowed
        FROM fx_orders GROUP BY 1""",
    "events_encode": """
        SELECT event_id, event_type AS routing_key, event_type, order_id, customer_id FROM fx_events""",
    "events_decode": """
        SELECT event_id, ts, event_type, order_id, customer_id FROM fx_decoded WHERE good""",
    "dead_letter": """
        SELECT event_id, ts, body, body[1:200] AS body_head FROM fx_decoded WHERE NOT good""",
    "routing_rules": """
        SELECT rule, pos, channel, template, retry, level,
               (SELECT count(*) FROM fx_events e
                WHERE e.event_type = r.rule
                   OR (r.rule = 'default' AND e.event_type NOT IN (SELECT rule FROM fx_rules)))
                   AS n_events
        FROM fx_rules r""",
    "route_events": """
        SELECT event_id, event_type, pos, channel, template, retry, level FROM fx_attempts""",
    "notifications": """
        SELECT e.event_id, e.event_type, r.pos, r.channel, r.template, e.order_id
        FROM fx_decoded e JOIN fx_rules r
          ON r.rule = CASE WHEN e.event_type IN (SELECT rule FROM fx_rules) THEN e.event_type
                           ELSE 'default' END
        WHERE e.good""",
    "topic_subscribe": """
        SELECT pattern, event_type, count(*) AS n_events
        FROM (SELECT '#' AS pattern, event_type FROM fx_events
              UNION ALL SELECT 'order.*', event_type FROM fx_events WHERE event_type LIKE 'order.%'
              UNION ALL SELECT '*.created', event_type FROM fx_events WHERE event_type = 'order.created'
              UNION ALL SELECT '#.shipped', event_type FROM fx_events WHERE event_type = 'order.shipped')
        GROUP BY 1, 2""",
    "topic_bindings": """
        WITH topics AS (
            SELECT e.event_type, 'svc-' || (user_id % 5) AS job, user_id % 50 AS u
            FROM fx_events e JOIN events USING (event_id)),
        matched AS (
            SELECT n_nationkey AS binding,
                   'order.*.svc-' || (n_nationkey % 5) || '.u' || n_nationkey AS pattern
            FROM topics JOIN nation ON u = n_nationkey AND job = 'svc-' || (n_nationkey % 5)
            UNION ALL SELECT n_nationkey, '#.u' || n_nationkey FROM topics JOIN nation ON u = n_nationkey
            UNION ALL SELECT n_nationkey, '*.created.#.u' || n_nationkey
            FROM topics JOIN nation ON u = n_nationkey AND event_type = 'order.created'
            UNION ALL SELECT n_nationkey, 'order.#.svc-' || n_nationkey || '.*'
            FROM topics JOIN nation ON job = 'svc-' || n_nationkey
            UNION ALL SELECT 0, '#' FROM topics)
        SELECT binding, pattern, count(*) AS n FROM matched GROUP BY ALL""",
    "order_topic": """
        SELECT event_id, event_type FROM fx_events WHERE event_type = 'order.created'""",
    "message_counts": """
        SELECT event_type, count(*) AS received, count(*) FILTER (ok) AS processed,
               count(*) FILTER (NOT ok) AS failed
        FROM (SELECT event_id, event_type, bool_and(delivered) AS ok FROM fx_attempts GROUP BY 1, 2)
        GROUP BY 1""",
    "delivery_attempts": """
        SELECT event_id, channel, retry, attempts_needed,
               least(attempts_needed, 1 + coalesce(retry, 0)) AS attempts_made,
               delivered, NOT delivered AS dead_letter
        FROM fx_attempts""",
    "events_dedup": """
        SELECT event_id, ts, event_type, order_id FROM fx_decoded WHERE good""",
    "orders_without_event": """
        SELECT id AS order_id, 'order without event' AS reason, 1::BIGINT AS n_orders, 0::BIGINT AS n_events
        FROM fx_orders WHERE id NOT IN (SELECT order_id FROM fx_events)
        UNION ALL
        SELECT order_id, 'event without order', 0, count(*) FROM fx_events
        WHERE order_id NOT IN (SELECT id FROM fx_orders) GROUP BY 1""",
    "event_rate": _RATE.format(keys="event_type", n="n", source="fx_events", where="true"),
    "received_vs_processed": """
        SELECT event_type, window_start, window_end,
               round(count(*) FILTER (ok) / count(*)::DOUBLE, 9) AS ratio
        FROM (SELECT event_id, ts, event_type, bool_and(delivered) AS ok FROM fx_attempts GROUP BY ALL)
        JOIN grid ON ts >= window_start AND ts < window_end
        GROUP BY event_type, window_start, window_end""",
    "published_per_created": """
        SELECT job, window_start, window_end,
               round((published / 21600.0::DOUBLE) / (created / 21600.0::DOUBLE), 9) AS ratio
        FROM s_publishing WHERE published > 0""",
    "request_counts": """
        SELECT method, path, status_code, count(*) AS n FROM fx_requests GROUP BY ALL""",
    "latency_histogram": """
        SELECT method, path, le, count(*) FILTER (duration_seconds <= le) AS cum_count,
               count(*) AS observations, round(sum(duration_seconds), 4) AS observed_sum
        FROM fx_requests, bounds GROUP BY ALL""",
    "metrics_text": """
        WITH h AS (
            SELECT 'method="' || method || '",path="' || path || '"' AS labels, * FROM fx_requests)
        SELECT 'requests_total{' || labels || ',status_code="' || status_code || '"} ' || count(*) AS line
        FROM h GROUP BY labels, status_code
        UNION ALL
        SELECT 'request_duration_seconds_bucket{' || labels || ',le="'
               || CASE le WHEN 'Infinity'::DOUBLE THEN '+Inf'
                          WHEN 1 THEN '1' WHEN 5 THEN '5' WHEN 10 THEN '10'
                          ELSE CAST(le AS VARCHAR) END
               || '"} ' || count(*) FILTER (duration_seconds <= le)
        FROM h, bounds GROUP BY labels, le
        UNION ALL
        SELECT 'request_duration_seconds_sum{' || labels || '} '
               || CAST(round(sum(duration_seconds)) AS BIGINT) FROM h GROUP BY labels
        UNION ALL
        SELECT 'request_duration_seconds_count{' || labels || '} ' || count(*) FROM h GROUP BY labels""",
    "histogram_quantile": """
        SELECT job, window_start, window_end, round(quantile, 9) AS quantile FROM s_quantile""",
    "latency_quantile": """
        SELECT job, window_start, window_end, round(quantile, 9) AS quantile FROM s_quantile""",
    "error_ratio": "SELECT * FROM s_error_ratio",
    "series_cardinality": """
        SELECT 'requests_total' AS metric, count(*) AS n_series
        FROM (SELECT DISTINCT job, method, path, status_code FROM fx_requests)
        UNION ALL
        SELECT 'requests_by_raw_path_total', count(DISTINCT '/orders/' || event_id) FROM events""",
    "windowed_cardinality": _CARDINALITY,
    "stream_cardinality": _CARDINALITY,
    "label_regex_filter": """
        SELECT * FROM fx_requests WHERE regexp_full_match(status_code, '4..|5..')
                                    AND regexp_full_match(job, 'svc-[0-3]')""",
    "publishing_stalled": """
        SELECT job, window_start, window_end, created FROM s_publishing
        WHERE created > 0 AND published = 0""",
    "created_and_failing": """
        SELECT job, window_start, window_end, count(*) FILTER (status_code = '201') AS n,
               count(*) FILTER (status_code = '201') / 21600.0::DOUBLE AS rate
        FROM w_requests GROUP BY ALL
        HAVING count(*) FILTER (status_code = '201') > 0 AND count(*) FILTER (status_code = '500') > 0""",
    "samples_parse": """
        SELECT own_ts AS ts, 'requests_total' AS metric, job, status_code, value
        FROM fx_scrape_mixed WHERE NOT broken AND NOT doubled""",
    "samples_malformed": """
        SELECT ts, CASE WHEN broken THEN 'requests_total{job="' || job || '",status_code="' || status_code || '"'
                        ELSE 'requests_total{job="a",job="' || job || '"}' END AS name_and_labels
        FROM fx_scrape_mixed WHERE broken OR doubled""",
    "log_lines_escape": """
        SELECT event_id, 'he said "' || event_type || '"\\ ' || chr(10) || chr(9) || user_id AS message
        FROM events""",
    "counter_delta": """
        SELECT job, status_code, ts, value,
               lag(ts) OVER w AS prev_ts, lag(value) OVER w AS prev_value,
               CASE WHEN value < lag(value) OVER w THEN value ELSE value - lag(value) OVER w END AS delta
        FROM fx_counter WINDOW w AS (PARTITION BY job, status_code ORDER BY ts)""",
    "counter_rate": """
        SELECT job, status_code, window_start, window_end, round(increase / 21600, 9) AS rate
        FROM s_increase""",
    "restart_increase": "SELECT * FROM s_increase",
    "latest_sample": "SELECT * FROM s_latest",
    "volume_free_ratio": "SELECT * FROM s_volume",
    "cpu_utilisation": """
        SELECT job, window_start, window_end, round(avg(pct), 9) AS utilisation_pct, avg(pct) > 70 AS above_target
        FROM (SELECT job, pod, window_start, window_end, avg(value / 100.0 * 100) AS pct
              FROM fx_gauge JOIN grid ON ts >= window_start AND ts < window_end
              WHERE metric = 'cpu_usage' GROUP BY job, pod, window_start, window_end)
        GROUP BY job, window_start, window_end""",
    "alert_states": _STATES.format(source="(SELECT * FROM evaluated_all WHERE alert = 'HighErrorRate')"),
    **{
        f"alert_{name}": _STATES.format(source=f"(SELECT * FROM evaluated_all WHERE alert = '{alert}')")
        for name, alert in _ALERTS.items()
    },
    "alert_rules": " UNION ALL ".join(
        f"SELECT * FROM ({_STATES.format(source=f"(SELECT * FROM evaluated_all WHERE alert = '{alert}')")})"
        for alert in _ALERTS.values()
    ),
    "log_scan": """
        SELECT ts, uid, 'app' AS container, strftime(ts, '%Y-%m-%d %H:%M:%S,%g') AS time, level,
               message, CAST(status_code AS VARCHAR) AS status_code, line FROM fx_logs""",
    "pod_targets": """
        SELECT uid, namespace, pod, container, app,
               '/var/log/pods/*' || uid || '*/*' || container || '*/*.log' AS path_glob
        FROM fx_pods WHERE phase = 'Running'""",
    "logs_enriched": f"SELECT {_LOG_COLUMNS} FROM fx_enriched",
    "log_label_filter": f"""
        SELECT {_LOG_COLUMNS} FROM fx_enriched WHERE namespace = 'ASIA' AND app = 'svc-2'""",
    "log_line_filter": f"""
        SELECT {_LOG_COLUMNS} FROM fx_enriched WHERE level = 'ERROR' OR message <> 'GET /health'""",
    "log_line_regex": f"SELECT {_LOG_COLUMNS} FROM fx_enriched WHERE message = 'upstream timeout'",
    "log_json_filter": f"SELECT {_LOG_COLUMNS} FROM fx_enriched WHERE status_code >= 500",
    "log_error_rate": _RATE.format(
        keys="app", n="n_lines", source="fx_enriched", where="contains(line, 'ERROR')"
    ),
    "log_volume": _RATE.format(keys="namespace", n="n_lines", source="fx_enriched", where="app <> ''"),
    "log_quantile": """
        SELECT app, window_start, window_end, round(quantile_cont(duration_seconds, 0.95), 6) AS quantile
        FROM fx_enriched JOIN grid ON ts >= window_start AND ts < window_end GROUP BY ALL""",
    "log_quantile_by_app": """
        SELECT app, time_bucket(INTERVAL 30 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
               time_bucket(INTERVAL 30 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 30 DAY AS window_end,
               round(quantile_cont(duration_seconds, 0.95), 6) AS quantile
        FROM fx_enriched GROUP BY ALL""",
    "latency_weighted_quantile": """
        WITH counted AS (
            SELECT job, window_start, window_end, v, sum(w) AS w
            FROM fx_weighted JOIN grid ON ts >= window_start AND ts < window_end GROUP BY ALL),
        placed AS (
            SELECT *, sum(w) OVER (PARTITION BY job, window_end ORDER BY v) AS upto,
                   0.95 * (sum(w) OVER (PARTITION BY job, window_end) - 1) AS place FROM counted),
        ends AS (
            SELECT job, window_start, window_end, max(place) - floor(max(place)) AS fraction,
                   min(v) FILTER (upto > floor(place)) AS low, min(v) FILTER (upto > ceil(place)) AS high
            FROM placed GROUP BY ALL)
        SELECT job, window_start, window_end, round(low + (high - low) * fraction::DOUBLE, 6) AS quantile
        FROM ends""",
    "latency_summary": """
        WITH counted AS (
            SELECT job, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS bucket, v, sum(w) AS w
            FROM fx_weighted GROUP BY ALL),
        placed AS (
            SELECT *, sum(w) OVER (PARTITION BY job, bucket ORDER BY v) AS upto,
                   sum(w) OVER (PARTITION BY job, bucket) AS total FROM counted)
        SELECT job, bucket, v, (upto - w)::BIGINT AS before, upto::BIGINT AS upto, total::BIGINT AS total
        FROM placed
        WHERE upto = w OR ((upto - w) * 16) // total < (upto * 16) // total""",
    "text_escape": """
        SELECT page_id, sha256(replace(replace(replace(replace(replace(coalesce(html, ''), '&', '&amp;'),
            '<', '&lt;'), '>', '&gt;'), '"', '&#34;'), chr(39), '&#39;')) AS escaped_sha256
        FROM pages""",
    "log_search": """
        SELECT 'text' AS search, line FROM fx_logs WHERE trace_id = '77'
        UNION ALL
        SELECT 'regex', line FROM fx_logs
        WHERE message IN ('order created', 'upstream timeout') AND trace_id LIKE '%7'
              AND len(trace_id) BETWEEN 2 AND 3""",
    "log_tail": "SELECT ts, line FROM fx_logs ORDER BY ts DESC, line LIMIT 1000",
    "log_tail_many": "SELECT ts, line FROM fx_logs ORDER BY ts DESC, line LIMIT 3000",
    "log_last_hours": """
        SELECT ts, path FROM fx_logs
        WHERE ts >= TIMESTAMP '2024-01-15 06:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00'""",
    "log_trace_id": "SELECT ts, trace_id FROM fx_logs",
    "alert_logs": """
        WITH share AS (
            SELECT namespace, app, window_end AS eval_ts
            FROM fx_enriched JOIN grid ON ts >= window_start AND ts < window_end
            GROUP BY ALL HAVING count(*) FILTER (level = 'ERROR') / count(*)::DOUBLE > 0.2),
        runs AS (
            SELECT *, eval_ts - INTERVAL 1 HOUR
                      * row_number() OVER (PARTITION BY namespace, app ORDER BY eval_ts) AS island
            FROM share),
        fired AS (
            SELECT namespace, app, min(eval_ts) AS start_ts, max(eval_ts) AS end_ts
            FROM runs GROUP BY namespace, app, island
            HAVING max(eval_ts) - min(eval_ts) >= INTERVAL 3 HOUR)
        SELECT l.namespace, l.app, start_ts, end_ts, l.ts, l.trace_id
        FROM fx_enriched l JOIN fired f ON l.namespace = f.namespace AND l.app = f.app
             AND l.ts BETWEEN start_ts AND end_ts
        WHERE l.level = 'ERROR'""",
    "stream_route": """
        SELECT e.event_id, e.event_type, r.pos, r.channel, r.template
        FROM fx_decoded e JOIN fx_rules r
          ON r.rule = CASE WHEN e.event_type IN (SELECT rule FROM fx_rules) THEN e.event_type
                           ELSE 'default' END
        WHERE e.good""",
    "stream_dead_letter": """
        SELECT event_id, ts, body, body[1:200] AS body_head FROM fx_decoded WHERE NOT good""",
    "stream_dedup": "SELECT event_id, ts, event_type FROM fx_events",
    "stream_retry": """
        SELECT event_id, channel, CAST(least(attempts_needed, 1 + coalesce(retry, 0)) AS INTEGER)
                   AS attempts_made, delivered
        FROM fx_attempts""",
    "stream_dedup_all": "SELECT event_id, ts, event_type FROM fx_events",
    "stream_event_rate": _RATE.format(keys="event_type", n="n", source="fx_events", where="true"),
    "stream_windows": """
        SELECT event_type, window_start, window_end, count(*) AS n
        FROM fx_events JOIN grid ON ts >= window_start AND ts < window_end GROUP BY ALL""",
    "stream_error_ratio": "SELECT * FROM s_error_ratio",
    "stream_alert_states": f"""
        SELECT substr(labels, 9, 5) AS job, eval_ts, value, active_since, state
        FROM ({_STATES.format(source="(SELECT * FROM evaluated_all WHERE alert = 'HighErrorRate')")})""",
}


def _used(body: str) -> list[str]:
    """Views that ``body`` needs, directly or through others, in definition order."""
    names = list(_VIEWS)
    needed: set[str] = set()
    texts = [body]
    while texts:
        text = texts.pop()
        for name in names:
            if name not in needed and name in text:
                needed.add(name)
                texts.append(_VIEWS[name])
    return [name for name in names if name in needed]


def _once(name: str) -> str:
    """Series and evaluations are read several times, so they are computed once."""
    return "MATERIALIZED " if name.startswith(("s_", "w_", "evaluated")) else ""


def oracle_sql() -> dict[str, str]:
    statements = {}
    for key, body in _QUERIES.items():
        views = ", ".join(f"{name} AS {_once(name)}({_VIEWS[name]})" for name in _used(body))
        statements[key] = f"WITH {views} SELECT * FROM ({body})" if views else body
    return statements
