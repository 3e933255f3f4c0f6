"""DuckDB statements that state independently what each registered query returns.

They are written the plain way (global windows, window per key, spine joins),
so they share no method with the Spark side.
"""

from __future__ import annotations

ALL_READINGS = """
all_readings AS (
  SELECT event_id AS seq,
         '00000000-0000-4000-8000-' || printf('%012x', event_id) AS event_id,
         'customer-' || CAST(user_id AS VARCHAR) AS customer_id,
         CAST(floor(value) AS INTEGER) AS heart_rate,
         ts - to_microseconds(1000000 * CASE
              WHEN event_id % 200 = 0 THEN (event_id * 7919) % 172800
              WHEN event_id % 20 = 0 THEN (event_id * 7919) % 600 ELSE 0 END) AS event_time,
         ts AS sent_at,
         CAST(user_id % 3 AS INTEGER) AS src_partition,
         event_type, value
  FROM events)"""

READINGS = ALL_READINGS + """,
readings AS (SELECT * FROM all_readings WHERE heart_rate BETWEEN 20 AND 250)"""


ARRIVALS = """
    SELECT *, seq * 2 AS arrival FROM {0}
    UNION ALL
    SELECT *, (seq + CASE WHEN seq % 200 = 0 THEN 3 ELSE 1450 END) * 2 + 1 AS arrival
    FROM {0} WHERE seq % 100 = 0"""


def deliveries_cte(tick: int = 500) -> str:
    return READINGS + f""",
deliveries AS (
  SELECT *, arrival // {2 * tick} AS tick FROM ({ARRIVALS.format('readings')}))"""


def posted_cte(source: str) -> str:
    """Deliveries on a topic of three partitions, drained in four ticks of equal shares."""
    return f""",
posted AS (
  SELECT *, row_number() OVER (PARTITION BY src_partition ORDER BY arrival) - 1 AS src_offset
  FROM ({ARRIVALS.format(source)})),
longest AS (SELECT (max(src_offset) + 4) // 4 AS share FROM posted),
drained AS (SELECT posted.*, src_offset // share AS tick FROM posted, longest)"""


def tagged_cte(
    tick: int = 500, o: int = 300, lateness: int = 3600, width: int = 86400,
    deliveries: str | None = None,
) -> str:
    """Deliveries with watermark, lateness, is_new, window, and aggregated."""
    return (deliveries or deliveries_cte(tick)) + f""",
observed AS (
  SELECT *,
    max(event_time) OVER (ORDER BY tick, arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      - to_seconds({o}) AS watermark_before,
    row_number() OVER (PARTITION BY event_id ORDER BY tick, arrival) = 1 AS is_new,
    make_timestamp(epoch_us(event_time) - epoch_us(event_time) % {width * 1_000_000}) AS window_start
  FROM deliveries),
late AS (
  SELECT *, window_start + to_seconds({width}) AS window_end,
    CASE WHEN heart_rate BETWEEN 60 AND 100 THEN 'NORMAL' ELSE 'ABNORMAL' END AS status,
    coalesce(event_time < watermark_before, FALSE) AS is_late,
    CASE WHEN event_time < watermark_before
         THEN (epoch_us(watermark_before) - epoch_us(event_time)) / 1e6 END AS lateness_seconds
  FROM observed),
ticks AS (SELECT tick, max(event_time) AS top, count(*) AS n FROM deliveries GROUP BY tick),
ledger AS (
  SELECT tick, n, top,
    max(top) OVER (ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      - to_seconds({o}) AS w_before,
    max(top) OVER (ORDER BY tick ROWS UNBOUNDED PRECEDING) - to_seconds({o}) AS w_after
  FROM ticks),
placed AS (
  SELECT l.*, g.w_before,
    min(CASE WHEN is_new THEN l.tick END) OVER (PARTITION BY customer_id, window_start) AS first_tick
  FROM late l JOIN ledger g ON g.tick = l.tick),
tagged AS (
  SELECT *,
    is_new AND (tick = first_tick OR w_before IS NULL
                OR w_before <= window_end + to_seconds({lateness})) AS aggregated
  FROM placed),
outcomes AS (
  SELECT *, CASE WHEN NOT is_late THEN 'on_time' WHEN NOT is_new THEN 'duplicate'
                 WHEN aggregated THEN 'aggregated' ELSE 'finalized' END AS late_outcome
  FROM tagged),
windows AS (
  SELECT customer_id, window_start, window_end, count(*) AS event_count,
    CAST(sum(heart_rate) AS BIGINT) AS heart_rate_sum,
    round(sum(heart_rate) / count(*), 9) AS average_heart_rate,
    min(heart_rate) AS minimum_heart_rate, max(heart_rate) AS maximum_heart_rate,
    count(*) FILTER (WHERE status = 'ABNORMAL') AS abnormal_count,
    any_value(first_tick) AS first_tick
  FROM tagged WHERE aggregated GROUP BY ALL),
ends AS (
  SELECT e.window_end, min(g.tick) AS closing FROM (SELECT DISTINCT window_end FROM windows) e
  JOIN ledger g ON g.w_after > e.window_end + to_seconds({lateness}) GROUP BY 1),
daily AS (
  SELECT w.*, CASE WHEN e.closing IS NULL THEN NULL ELSE greatest(w.first_tick, e.closing) END
      AS finalized_tick,
    e.closing IS NOT NULL AS is_finalized
  FROM windows w LEFT JOIN ends e ON e.window_end = w.window_end),
raw AS (SELECT *, sent_at AS ingestion_time FROM late WHERE is_new)"""


# The first three faults decide which fields are wrong; the text follows.
KINDS = ALL_READINGS + """,
kinds AS (SELECT *, seq % 40 AS kind FROM all_readings)"""
OUTCOMES = """,
bounds AS (
  SELECT *,
    CASE WHEN kind IN (2, 9) THEN NULL
         WHEN kind = 6 AND heart_rate + 0.5 < 20 THEN ' is less than the minimum of 20'
         WHEN kind = 6 AND heart_rate + 0.5 > 250 THEN ' is greater than the maximum of 250'
         WHEN kind = 6 THEN NULL
         WHEN heart_rate < 20 THEN ' is less than the minimum of 20'
         WHEN heart_rate > 250 THEN ' is greater than the maximum of 250' END AS broken,
    CASE kind WHEN 2 THEN '''' || heart_rate || '''' WHEN 6 THEN heart_rate || '.5'
              WHEN 9 THEN 'True' WHEN 17 THEN heart_rate || '.0'
              ELSE CAST(heart_rate AS VARCHAR) END AS shown
  FROM kinds),
found AS (
  SELECT *,
    CASE kind
      WHEN 7 THEN 'Undecodable JSON'
      WHEN 16 THEN 'Undecodable JSON'
      WHEN 8 THEN 'event: [' || heart_rate || '] is not of type ''object'''
      ELSE nullif(concat_ws('; ',
        CASE kind WHEN 3 THEN
          'event: Additional properties are not allowed (''firmware_version'' was unexpected)'
          WHEN 1 THEN 'event: ''customer_id'' is a required property'
          WHEN 11 THEN 'event: ''event_time'' is a required property' END,
        CASE kind WHEN 5 THEN 'customer_id: '''' should be non-empty'
          WHEN 10 THEN 'customer_id: None is not of type ''string''' END,
        CASE WHEN kind IN (2, 6, 9) THEN 'heart_rate: ' || shown || ' is not of type ''integer''' END,
        'heart_rate: ' || shown || broken), '') END AS contract_error
  FROM bounds),
validated AS (
  SELECT *,
    coalesce(contract_error,
      CASE kind WHEN 0 THEN 'Invalid event_id' WHEN 4 THEN 'Invalid event_time'
                WHEN 12 THEN 'Invalid event_time' END) AS error_message,
    CASE WHEN kind IN (7, 16) THEN 'DECODE_ERROR'
         WHEN contract_error IS NOT NULL OR kind IN (0, 4, 12) THEN 'VALIDATION_ERROR' END
      AS error_type
  FROM found),
letters AS (
  SELECT *, CASE WHEN kind IN (1, 7, 8, 10, 16) THEN 'unknown' WHEN kind = 5 THEN ''
                 ELSE customer_id END AS dlq_key
  FROM validated WHERE error_type IS NOT NULL)"""
MESSAGES = KINDS.replace("FROM all_readings)", "FROM all_readings WHERE seq % 40 <> 16)") + OUTCOMES

# A payload's length follows from the lengths of its parts.
ORIGINAL_LENGTH = """CAST(CASE kind WHEN 16 THEN 2 WHEN 8 THEN length(CAST(heart_rate AS VARCHAR)) + 2 ELSE
    2 + 13 + CASE kind WHEN 0 THEN 10 WHEN 13 THEN 38 ELSE 36 END
    + CASE kind WHEN 1 THEN 0 WHEN 5 THEN 16 + 1 WHEN 10 THEN 18 + 1
           ELSE 16 + length(customer_id) + 1 END
    + 1 + 13 + length(CAST(heart_rate AS VARCHAR))
    + CASE kind WHEN 2 THEN 2 WHEN 6 THEN 2 WHEN 17 THEN 2
           WHEN 9 THEN 4 - length(CAST(heart_rate AS VARCHAR)) ELSE 0 END
    + CASE kind WHEN 11 THEN 0 WHEN 4 THEN 1 + 15 + 26 WHEN 12 THEN 1 + 15 + 10
           WHEN 14 THEN 1 + 15 + 27 WHEN 15 THEN 1 + 15 + 31 ELSE 1 + 15 + 32 END
    + CASE kind WHEN 3 THEN 25 ELSE 0 END - CASE kind WHEN 7 THEN 1 ELSE 0 END
  END AS BIGINT)"""

BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
LIMITS = [*(repr(b) for b in BOUNDS), "'Infinity'::DOUBLE"]
LABELS = [*(repr(b) for b in BOUNDS), "+Inf"]


def _le_values() -> str:
    return ", ".join(
        f"({limit}, '{label}', '{'+Inf' if label == '+Inf' else format(float(label), '.3f')}')"
        for limit, label in zip(LIMITS, LABELS, strict=True)
    )


BUCKETS = f"bounds(le, label, shown) AS (VALUES {_le_values()})"

# Samples at ten-minute scrapes; step numbers count scrapes since the epoch.
SAMPLES = ALL_READINGS + f""",
{BUCKETS},
at_scrape AS (
  SELECT *, (epoch_us(sent_at) + 599999999) // 600000000 AS scrape, value / 100.0 AS seconds
  FROM all_readings),
per_scrape AS (
  SELECT src_partition, scrape,
    count(*) FILTER (WHERE heart_rate BETWEEN 20 AND 250) AS processed,
    count(*) FILTER (WHERE heart_rate NOT BETWEEN 20 AND 250) AS letters,
    count(*) FILTER (WHERE heart_rate BETWEEN 20 AND 250
                     AND heart_rate NOT BETWEEN 60 AND 100) AS abnormal,
    count(*) FILTER (WHERE heart_rate BETWEEN 20 AND 250 AND event_time < sent_at
                     AND event_time >= sent_at - INTERVAL 600 SECONDS) AS late_true,
    count(*) FILTER (WHERE heart_rate BETWEEN 20 AND 250
                     AND event_time < sent_at - INTERVAL 600 SECONDS) AS late_false,
    max(heart_rate) AS peak, max(epoch_us(sent_at)) AS last_seen,
    count(*) FILTER (WHERE event_type = 'view') AS views,
    count(*) FILTER (WHERE event_type = 'signup') AS signups
  FROM at_scrape GROUP BY ALL),
bucket_scrape AS (
  SELECT src_partition, scrape, label, le, count(*) FILTER (WHERE seconds <= le) AS n
  FROM at_scrape CROSS JOIN bounds GROUP BY ALL),
counted AS (
  SELECT src_partition, scrape, peak, last_seen, views,
    sum(processed) OVER w AS processed, sum(letters) OVER w AS letters,
    sum(abnormal) OVER w AS abnormal, sum(late_true) OVER w AS late_true,
    sum(late_false) OVER w AS late_false, sum(signups) OVER w AS signups
  FROM per_scrape
  WINDOW w AS (PARTITION BY src_partition, scrape // 144 ORDER BY scrape
               ROWS UNBOUNDED PRECEDING)),
samples AS (
  SELECT scrape, 'instance-' || src_partition AS instance, v.name AS name, v.label AS label,
         CAST(v.value AS DOUBLE) AS value
  FROM counted, LATERAL (VALUES
    ('processed', '', processed), ('letters', '', letters), ('failed', 'validation', letters),
    ('abnormal', '', abnormal), ('late', 'true', late_true), ('late', 'false', late_false),
    ('lag', '', (scrape * 600000000 - last_seen) / 1e6 + 300), ('open', '', signups),
    ('closed', '', late_true + late_false), ('partition_lag', '', peak * 20),
    ('up', '', CASE WHEN views > 0 THEN 1 ELSE 0 END),
    ('sink_up', '', CASE WHEN peak > 60 THEN 1 ELSE 0 END)) v(name, label, value)
  UNION ALL
  SELECT scrape, 'instance-' || src_partition, 'bucket', label,
         CAST(sum(n) OVER (PARTITION BY src_partition, label, scrape // 144 ORDER BY scrape
                           ROWS UNBOUNDED PRECEDING) AS DOUBLE)
  FROM bucket_scrape),
deltas AS (
  SELECT *, CASE WHEN previous IS NULL THEN 0 WHEN value < previous THEN value
                 ELSE value - previous END AS delta
  FROM (SELECT *, lag(value) OVER (PARTITION BY name, label, instance ORDER BY scrape) AS previous
        FROM samples))"""


def rates_cte(alias: str, steps: int) -> str:
    """Every series at every step whose range of ``steps`` scrapes holds samples."""
    over = steps * 600.0
    return f"""
{alias}_raw AS (
  SELECT name, label, instance, scrape + ahead AS step, scrape, value, delta
  FROM deltas CROSS JOIN range({steps}) r(ahead)),
{alias}_seen AS (
  SELECT name, label, instance, step, count(*) AS n,
    sum(delta) - arg_min(delta, scrape) AS grown, arg_min(value, scrape) AS first_value,
    min(scrape) * 600.0 AS first_ts, max(scrape) * 600.0 AS last_ts, step * 600.0 AS moment
  FROM {alias}_raw GROUP BY name, label, instance, step HAVING count(*) >= 2),
{alias}_edges AS (
  SELECT *, last_ts - first_ts AS sampled, (last_ts - first_ts) / (n - 1) AS gap,
    first_ts - (moment - {over}) AS head, moment - last_ts AS tail
  FROM {alias}_seen),
{alias}_capped AS (
  SELECT *, CASE WHEN head >= gap * 1.1 THEN gap / 2 ELSE head END AS head1,
    CASE WHEN tail >= gap * 1.1 THEN gap / 2 ELSE tail END AS tail1
  FROM {alias}_edges),
{alias} AS (
  SELECT name, label, instance, step, grown,
    grown * (sampled + tail1 + CASE WHEN grown > 0
        AND sampled * (first_value / grown) < head1
      THEN sampled * (first_value / grown) ELSE head1 END) / sampled AS increased,
    increased / {over} AS rate
  FROM {alias}_capped)"""


def now_cte(alias: str, steps: int) -> str:
    """Latest value per series at every step, while younger than ``steps`` scrapes."""
    return f"""
{alias} AS (
  SELECT name, label, instance, scrape + ahead AS step, arg_max(value, scrape) AS value
  FROM samples CROSS JOIN range({steps}) r(ahead) GROUP BY 1, 2, 3, 4)"""


def quantile_cte(alias: str, source: str, q: str, by: str = "step") -> str:
    """``source`` has (by, le, n); answers (by, q, value) for the quantiles ``q``."""
    return f"""
{alias}_ranked AS (
  SELECT {by}, le, n, lag(le) OVER w AS lower, coalesce(lag(n) OVER w, 0) AS below,
    max(n) OVER (PARTITION BY {by}) AS total
  FROM {source} WINDOW w AS (PARTITION BY {by} ORDER BY le)),
{alias} AS (
  SELECT {by}, q, arg_min(CASE WHEN total <= 0 THEN NULL WHEN isinf(le) THEN lower
      ELSE coalesce(lower, 0) + (le - coalesce(lower, 0)) * (q * total - below) / (n - below) END,
      le) AS value
  FROM {alias}_ranked CROSS JOIN (SELECT unnest([{q}]) AS q)
  WHERE n >= q * total * (1 - 1e-12) GROUP BY {by}, q)"""


STEP_TIME = "make_timestamp({} * 600000000)"


def _at(column: str) -> str:
    return STEP_TIME.format(column)


LATENCY_RATES = """
bucket_rates AS (
  SELECT step, b.le, sum(rate) AS n FROM long_rates l JOIN bounds b USING (label)
  WHERE l.name = 'bucket' GROUP BY ALL)"""

# Rules with hold times of the test settings, in steps.
CONDITIONS = f"""
{rates_cte('long_rates', 6)},
{now_cte('now1', 1)},
{LATENCY_RATES},
{quantile_cte('p95', 'bucket_rates', '0.95')},
span AS (SELECT min(scrape) AS lo, max(scrape) AS hi FROM samples),
spine AS (SELECT unnest(range(lo, hi + 1)) AS step FROM span),
shares AS (
  SELECT step, d / greatest(d + p, 0.001) AS value FROM (
    SELECT step, sum(rate) FILTER (WHERE name = 'letters') AS d,
           sum(rate) FILTER (WHERE name = 'processed') AS p
    FROM long_rates GROUP BY step) WHERE d IS NOT NULL AND p IS NOT NULL),
active AS (
  SELECT 'ConsumerDown' AS alertname, 'CRITICAL' AS severity, 'consumer' AS component, 1 AS hold,
         instance, step FROM now1 WHERE name = 'up' AND value = 0
  UNION ALL SELECT 'ConsumerDown', 'CRITICAL', 'consumer', 1, '', step FROM spine
    WHERE step NOT IN (SELECT step FROM now1 WHERE name = 'up')
  UNION ALL SELECT 'PostgresUnavailable', 'CRITICAL', 'postgres', 1, instance, step
    FROM now1 WHERE name = 'sink_up' AND value = 0
  UNION ALL SELECT 'KafkaLagHigh', 'WARNING', 'consumer', 2, '', step FROM (
    SELECT step, sum(value) AS v FROM now1 WHERE name = 'partition_lag' GROUP BY step)
    WHERE v > 10000
  UNION ALL SELECT 'ProcessingLatencyHigh', 'WARNING', 'consumer', 3, '', step FROM p95
    WHERE value > 4.5
  UNION ALL SELECT 'DLQRateHigh', 'WARNING', 'consumer', 3, '', step FROM shares
    WHERE value > 0.3617
  UNION ALL SELECT 'WatermarkStuck', 'WARNING', 'consumer', 4, '', step FROM (
    SELECT step, max(value) AS v FROM now1 WHERE name = 'lag' GROUP BY step) WHERE v > 600),
islands AS (
  SELECT *, step - row_number() OVER (PARTITION BY alertname, instance ORDER BY step) AS island
  FROM active),
alerts AS (
  SELECT *, min(step) OVER (PARTITION BY alertname, instance, island) AS since,
    CASE WHEN step - since >= hold THEN 'firing' ELSE 'pending' END AS state
  FROM islands),
kept AS (
  SELECT * FROM alerts a WHERE state = 'firing' AND (alertname = 'ConsumerDown' OR NOT EXISTS (
    SELECT 1 FROM alerts s WHERE s.state = 'firing' AND s.alertname = 'ConsumerDown'
      AND s.step = a.step AND s.component = a.component))),
grouped AS (
  SELECT alertname, component, step, min(severity) AS severity, count(*) AS alerts,
    min(since) AS oldest, string_agg(instance, ',' ORDER BY instance) AS members
  FROM kept GROUP BY ALL)"""

_ALERT = """
  SELECT e.event_id AS arrival, e.ts, {position} AS position, {user} AS u, '{status}' AS status
  FROM events e WHERE {where}"""

ALERT_LOG = f"""
entries AS (
  {_ALERT.format(position=0, user='user_id', status='FIRING', where="event_type IN ('error', 'click')")}
  UNION ALL
  {_ALERT.format(position=0, user='user_id', status='RESOLVED', where="event_type = 'signup'")}
  UNION ALL
  {_ALERT.format(position=1, user='user_id + 1', status='RESOLVED', where="event_type = 'click'")}
  UNION ALL
  {_ALERT.format(position=1, user='user_id', status='FIRING', where="event_type = 'view'")}),
parts AS (
  SELECT *,
    CASE WHEN u % 7 = 6 THEN NULL
         ELSE ['ConsumerDown', 'DLQRateHigh', 'KafkaLagHigh', 'WatermarkStuck', ''][u % 5 + 1]
    END AS alertname,
    CASE WHEN u % 11 = 10 THEN NULL
         ELSE ['CRITICAL', ' warning ', 'Info', 'catastrophic'][u % 4 + 1] END AS sev,
    CASE WHEN u % 3 = 0 THEN 'host-' || u END AS instance,
    CASE WHEN u % 3 = 1 THEN ' worker ' END AS job,
    CASE WHEN u % 13 <> 12 THEN 'ingest' END AS service,
    u % 9 <> 8 AS noted
  FROM entries),
log AS (
  SELECT arrival, position, ts AS received_at, status,
    CASE WHEN u % 5 <> 0 THEN 'fp-' || u ELSE substr(sha256(concat_ws(',',
      'alertname=' || alertname, 'instance=' || instance, 'job=' || job, 'service=' || service,
      'severity=' || sev, 'unit=' || u)), 1, 16) END AS fingerprint,
    CASE alertname WHEN 'ConsumerDown' THEN 'CONSUMER_DOWN' WHEN 'DLQRateHigh' THEN 'DLQ_RATE_HIGH'
      WHEN 'KafkaLagHigh' THEN 'KAFKA_LAG_HIGH' WHEN 'WatermarkStuck' THEN 'WATERMARK_STUCK'
      ELSE 'UNKNOWN' END AS alert_type,
    CASE sev WHEN 'CRITICAL' THEN 'CRITICAL' WHEN ' warning ' THEN 'WARNING' ELSE 'INFO' END
      AS severity,
    CASE WHEN noted AND u % 4 < 2 THEN 'unit ' || u
         WHEN noted AND u % 6 = 3 THEN 'see runbook'
         ELSE coalesce(alertname, 'Alert') || ' fired' END AS message,
    coalesce(instance, trim(job), service) AS source,
    CASE arrival % 10 WHEN 7 THEN date_trunc('second', ts) ELSE ts END AS created_at,
    1 + (alertname IS NOT NULL)::INT + (sev IS NOT NULL)::INT + (instance IS NOT NULL)::INT
      + (job IS NOT NULL)::INT + (service IS NOT NULL)::INT AS label_count
  FROM parts),
moves AS (
  SELECT *, CASE
      WHEN status = 'FIRING' AND coalesce(previous, 'RESOLVED') = 'RESOLVED' THEN 'opened'
      WHEN status = 'RESOLVED' AND previous = 'FIRING' THEN 'closed' ELSE 'ignored' END
      AS transition
  FROM (SELECT *, lag(status) OVER (PARTITION BY fingerprint ORDER BY arrival, position) AS previous
        FROM log)),
tagged AS (
  SELECT *, CAST(sum(CASE WHEN transition = 'opened' THEN 1 ELSE 0 END) OVER (
      PARTITION BY fingerprint ORDER BY arrival, position ROWS UNBOUNDED PRECEDING) AS BIGINT)
      AS episode_no
  FROM moves),
history AS (
  SELECT o.fingerprint, o.episode_no, o.alert_type, o.severity, o.message, o.source,
    CASE WHEN c.received_at IS NULL THEN 'FIRING' ELSE 'RESOLVED' END AS status,
    o.created_at, c.received_at AS resolved_at
  FROM (SELECT * FROM tagged WHERE transition = 'opened') o
  LEFT JOIN (SELECT * FROM tagged WHERE transition = 'closed') c
    ON c.fingerprint = o.fingerprint AND c.episode_no = o.episode_no)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _rounded(column: str, digits: int) -> str:
    return f"CAST(round(CAST({column} AS DECIMAL(24,9)), {digits}) AS DOUBLE)"


def _checks(rules: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT ({rule})) AS violations FROM {source}"
        for name, rule in rules.items()
    )


def oracles() -> dict[str, str]:
    tagged = tagged_cte()
    out: dict[str, str] = {}

    out["daily_aggregates"] = _with(READINGS) + """
SELECT customer_id, date_trunc('day', event_time)::TIMESTAMP AS window_start,
  date_trunc('day', event_time)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
  count(*) AS event_count, CAST(sum(heart_rate) AS BIGINT) AS heart_rate_sum,
  round(sum(heart_rate) / count(*), 9) AS average_heart_rate,
  min(heart_rate) AS minimum_heart_rate, max(heart_rate) AS maximum_heart_rate,
  count(*) FILTER (WHERE heart_rate < 60 OR heart_rate > 100) AS abnormal_count
FROM readings GROUP BY 1, 2, 3"""

    out["classified_readings"] = _with(ALL_READINGS) + """
SELECT event_id, customer_id, heart_rate,
  CASE WHEN heart_rate >= 60 AND heart_rate <= 100 THEN 'NORMAL' ELSE 'ABNORMAL' END AS status,
  event_time, date_trunc('day', event_time)::TIMESTAMP AS window_start,
  date_trunc('day', event_time)::TIMESTAMP + INTERVAL 1 DAY AS window_end
FROM all_readings"""

    out["contract_outcomes"] = _with(MESSAGES) + """
SELECT seq AS "offset", error_type IS NULL AS is_valid, error_type, error_message FROM validated"""

    out["device_contract"] = """
WITH cases AS (
  SELECT *, event_id % 16 AS c,
    event_type IN ('view', 'click', 'purchase') AS known FROM events),
found AS (
  SELECT *, nullif(concat_ws('; ',
    CASE c WHEN 6 THEN 'event: ''reading'' is a required property' END,
    CASE WHEN NOT known THEN 'kind: ''' || event_type || ''' is not one of [''view'', ''click'', ''purchase'']' END,
    CASE c WHEN 5 THEN 'reading: [70] is not of type ''object'''
      WHEN 8 THEN 'reading: None is not of type ''object'''
      WHEN 1 THEN 'reading: ''unit'' is a required property'
      WHEN 2 THEN 'reading: Additional properties are not allowed (''extra'' was unexpected)'
      WHEN 4 THEN 'reading.unit: ''kg'' is not one of [''bpm'', ''ms'']'
      WHEN 3 THEN 'reading.value: ''70'' is not of type ''number'''
      WHEN 7 THEN 'reading.value: -3 is less than the minimum of 0' END,
    CASE c WHEN 10 THEN 'trusted: ''yes'' is not of type ''boolean''' END,
    CASE c WHEN 9 THEN 'user: True is not of type ''integer''' END), '') AS error_message
  FROM cases)
SELECT event_id AS "offset", error_message IS NULL AS is_valid, error_message,
  CASE WHEN error_message IS NULL THEN event_type END AS kind,
  CASE WHEN error_message IS NULL THEN CAST(user_id AS INTEGER) END AS "user",
  CASE WHEN error_message IS NULL AND c = 11 THEN FALSE END AS trusted,
  CASE WHEN error_message IS NULL THEN CAST(event_id % 300 AS DOUBLE) END AS reading_value,
  CASE WHEN error_message IS NULL THEN 'bpm' END AS reading_unit
FROM found"""

    out["valid_readings"] = _with(MESSAGES) + """
SELECT event_id, customer_id, heart_rate, event_time,
  CASE WHEN heart_rate BETWEEN 60 AND 100 THEN 'NORMAL' ELSE 'ABNORMAL' END AS status,
  'heart-rate-events' AS src_topic, src_partition, seq AS src_offset
FROM validated WHERE error_type IS NULL"""

    out["dead_letters"] = _with(MESSAGES) + f"""
SELECT {ORIGINAL_LENGTH} AS original_length,
  error_type, error_message, 'heart-rate-events' AS source_topic,
  src_partition AS source_partition, seq AS source_offset, sent_at AS failed_at, dlq_key
FROM letters"""

    out["dead_letter_head"] = _with(MESSAGES) + """
SELECT src_partition AS source_partition, seq AS source_offset, error_type, error_message, dlq_key
FROM letters ORDER BY src_partition, seq LIMIT 25"""

    out["dead_letters_by_error"] = _with(MESSAGES) + """
SELECT src_partition AS "partition", count(*) FILTER (WHERE error_type = 'DECODE_ERROR')
    AS failed_decode,
  count(*) FILTER (WHERE error_type = 'VALIDATION_ERROR') AS failed_validation,
  count(*) FILTER (WHERE error_type IS NOT NULL) AS dead_lettered
FROM validated GROUP BY 1"""

    out["dead_letter_retention"] = _with(MESSAGES) + """
SELECT src_partition AS source_partition, seq AS source_offset, sent_at AS failed_at
FROM letters WHERE sent_at >= (SELECT max(ts) FROM events) - INTERVAL 7 DAYS"""

    out["messages_by_key"] = _with(READINGS) + """
SELECT customer_id AS key, count(*) AS messages, CAST(sum(length(body)) AS BIGINT) AS characters,
  min(body) AS first_value, max(body) AS last_value
FROM (SELECT customer_id, '{"event_id":"' || event_id || '","customer_id":"' || customer_id
    || '","heart_rate":' || heart_rate || ',"event_time":"'
    || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f+00:00') || '"}' AS body FROM readings)
GROUP BY 1"""

    out["lateness"] = _with(tagged) + """
SELECT arrival, event_id, event_time, watermark_before, is_late,
  round(lateness_seconds, 9) AS lateness_seconds FROM late"""

    out["lateness_per_partition"] = _with(deliveries_cte()) + """,
observed AS (
  SELECT *, max(event_time) OVER (PARTITION BY src_partition ORDER BY arrival
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 300 SECONDS AS watermark_before
  FROM deliveries)
SELECT arrival, src_partition, watermark_before,
  coalesce(event_time < watermark_before, FALSE) AS is_late,
  round(CASE WHEN event_time < watermark_before
    THEN (epoch_us(watermark_before) - epoch_us(event_time)) / 1e6 END, 9) AS lateness_seconds
FROM observed"""

    out["watermark_ledger"] = _with(tagged) + """
SELECT tick, n AS deliveries, top AS max_event_time, w_before AS watermark_before,
  w_after AS watermark_after FROM ledger"""

    out["watermark_lag"] = _with(tagged) + """
SELECT g.tick, any_value(w_after) AS watermark_after,
  round((epoch_us(max(sent_at)) - epoch_us(any_value(w_after))) / 1e6, 9) AS watermark_lag_seconds
FROM ledger g JOIN deliveries d ON d.tick = g.tick GROUP BY g.tick"""

    out["first_arrivals"] = _with(tagged) + "SELECT arrival, event_id, is_new FROM observed"

    out["deduplicated"] = _with(deliveries_cte()) + """
SELECT customer_id, count(*) AS events, max(first) AS last_arrival FROM (
  SELECT event_id, customer_id, min(arrival) AS first FROM deliveries GROUP BY 1, 2) GROUP BY 1"""

    halves = """,
half AS (SELECT max(arrival) // 2 AS middle FROM deliveries),
ranked AS (SELECT d.*, row_number() OVER (PARTITION BY event_id ORDER BY arrival) = 1 AS is_new,
  arrival > middle AS later FROM deliveries d, half)"""
    out["insert_if_absent"] = _with(deliveries_cte()) + halves + """
SELECT arrival, event_id, is_new FROM ranked WHERE later"""

    out["merged_state"] = _with(deliveries_cte()) + halves + """
SELECT customer_id, date_trunc('day', event_time)::TIMESTAMP AS window_start,
  count(*) AS event_count, CAST(sum(heart_rate) AS BIGINT) AS heart_rate_sum,
  min(heart_rate) AS minimum_heart_rate, max(heart_rate) AS maximum_heart_rate,
  count(*) FILTER (WHERE heart_rate NOT BETWEEN 60 AND 100) AS abnormal_count,
  round(sum(heart_rate) / count(*), 9) AS average_heart_rate
FROM ranked WHERE is_new GROUP BY 1, 2 HAVING bool_or(later)"""

    out["delivery_outcomes"] = _with(tagged) + """
SELECT arrival, event_id, tick, status, is_late, round(lateness_seconds, 9) AS lateness_seconds,
  is_new, aggregated, late_outcome FROM outcomes"""

    out["daily_by_event_time"] = _with(tagged) + """
SELECT customer_id, window_start, event_count, heart_rate_sum, average_heart_rate,
  minimum_heart_rate, maximum_heart_rate, abnormal_count, first_tick, finalized_tick, is_finalized
FROM daily"""

    out["daily_flush_every_event"] = _with(_flush_every_event()) + """
SELECT customer_id, window_start, event_count, heart_rate_sum, is_finalized FROM daily"""

    out["hourly_by_event_time"] = _with(tagged_cte(lateness=600, width=3600)) + """
SELECT customer_id, window_start, window_end, event_count, finalized_tick FROM daily"""

    out["duplicate_estimate"] = _with(deliveries_cte()) + """
SELECT count(*) AS stored, count(DISTINCT event_id) AS distinct_ids, TRUE AS within_error FROM deliveries"""
    out["evolved_windows"] = _with(tagged) + """
SELECT customer_id, window_start, event_count, is_finalized AND event_count % 2 = 1 AS is_finalized,
  CASE event_count % 2 WHEN 1 THEN 'stream' ELSE 'import' END AS source FROM daily"""

    out["finalized_gate"] = _with(tagged) + """
SELECT coalesce(NOT d.is_finalized, TRUE) AS accepted, count(*) AS rows,
  count(DISTINCT (l.customer_id, l.window_start)) AS windows
FROM late l LEFT JOIN daily d USING (customer_id, window_start) GROUP BY 1"""

    out["window_gauges"] = _with(tagged) + """,
changes AS (
  SELECT first_tick AS tick, 1 AS opened, 0 AS finalized FROM daily
  UNION ALL SELECT finalized_tick, 0, 1 FROM daily WHERE is_finalized),
per_tick AS (SELECT tick, sum(opened) AS o, sum(finalized) AS f FROM changes GROUP BY 1)
SELECT tick, CAST(o AS BIGINT) AS opened, CAST(f AS BIGINT) AS finalized,
  CAST(sum(o - f) OVER (ORDER BY tick) AS BIGINT) AS windows_open FROM per_tick"""

    out["native_watermark_daily"] = _with(READINGS) + """
SELECT customer_id, date_trunc('day', event_time)::TIMESTAMP AS window_start,
  date_trunc('day', event_time)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
  count(*) AS event_count, round(sum(heart_rate) / count(*), 9) AS average_heart_rate,
  min(heart_rate) AS minimum_heart_rate, max(heart_rate) AS maximum_heart_rate,
  count(*) FILTER (WHERE heart_rate NOT BETWEEN 60 AND 100) AS abnormal_count
FROM readings GROUP BY 1, 2, 3"""

    streamed = tagged_cte(
        deliveries=READINGS + posted_cte("readings") + """,
deliveries AS (SELECT * FROM drained)""")
    everything = KINDS + OUTCOMES + posted_cte("validated")
    composed = tagged_cte(deliveries=everything + """,
deliveries AS (SELECT * FROM drained WHERE error_type IS NULL)""")
    # The engine drops rows of windows that the watermark of two ticks before has passed.
    out["stream_native_daily"] = _with(READINGS + posted_cte("readings")) + """,
tops AS (SELECT tick, max(event_time) AS top FROM drained GROUP BY 1),
marks AS (
  SELECT tick, max(top) OVER (ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
    - INTERVAL 3900 SECONDS AS mark FROM tops),
placed AS (
  SELECT d.*, mark, date_trunc('day', event_time)::TIMESTAMP AS window_start,
    date_trunc('day', event_time)::TIMESTAMP + INTERVAL 1 DAY AS window_end
  FROM drained d JOIN marks USING (tick))
SELECT customer_id, window_start, window_end, count(*) AS event_count,
  CAST(sum(heart_rate) AS BIGINT) AS heart_rate_sum, min(heart_rate) AS minimum_heart_rate,
  max(heart_rate) AS maximum_heart_rate, count(*) FILTER (WHERE heart_rate NOT BETWEEN 60 AND 100) AS abnormal_count,
  round(sum(heart_rate) / count(*), 9) AS average_heart_rate
FROM placed WHERE mark IS NULL OR window_end > mark GROUP BY 1, 2, 3"""
    out["stream_daily"] = _with(streamed) + """
SELECT customer_id, window_start, window_end, event_count, heart_rate_sum, average_heart_rate,
  minimum_heart_rate, maximum_heart_rate, abnormal_count, is_finalized FROM daily"""
    out["stream_raw"] = _with(streamed) + """
SELECT event_id, customer_id, heart_rate, event_time, status, is_late,
  round(lateness_seconds, 9) AS lateness_seconds, tick FROM raw"""
    out["event_path_raw"] = _with(composed) + """
SELECT event_id, customer_id, heart_rate, event_time, status, is_late,
  round(lateness_seconds, 9) AS lateness_seconds, 'heart-rate-events' AS src_topic, src_partition,
  src_offset, tick FROM raw"""
    out["event_path_daily"] = _with(composed) + """
SELECT customer_id, window_start, window_end, event_count, heart_rate_sum, average_heart_rate,
  minimum_heart_rate, maximum_heart_rate, abnormal_count, is_finalized FROM daily"""
    out["event_path_dead_letters"] = _with(everything) + f"""
SELECT {ORIGINAL_LENGTH} AS original_length, error_type, error_message,
  'heart-rate-events' AS source_topic, src_partition AS source_partition, src_offset AS source_offset,
  CASE WHEN kind IN (1, 7, 8, 10, 16) THEN 'unknown' WHEN kind = 5 THEN '' ELSE customer_id END
    AS dlq_key, tick
FROM drained WHERE error_type IS NOT NULL"""
    out["stream_notifications"] = _with(ALERT_LOG) + "SELECT * FROM history"
    # An alert that was not repeated for six hours is over then, if the data goes on for so long.
    out["stream_auto_resolved"] = _with(ALERT_LOG) + """,
timed AS (
  SELECT *, coalesce(previous = 'FIRING' AND received_at - before <= INTERVAL 6 HOURS, FALSE) AS was_open
  FROM (SELECT *, lag(status) OVER w AS previous, lag(received_at) OVER w AS before FROM log
        WINDOW w AS (PARTITION BY fingerprint ORDER BY arrival, position))),
numbered AS (
  SELECT *, CAST(sum(CASE WHEN status = 'FIRING' AND NOT was_open THEN 1 ELSE 0 END) OVER (
      PARTITION BY fingerprint ORDER BY arrival, position ROWS UNBOUNDED PRECEDING) AS BIGINT)
      AS episode_no
  FROM timed),
ended AS (
  SELECT fingerprint, episode_no,
    min(received_at) FILTER (WHERE status = 'RESOLVED' AND was_open) AS told,
    max(received_at) FILTER (WHERE status = 'FIRING') + INTERVAL 6 HOURS AS silent
  FROM numbered GROUP BY 1, 2),
last AS (SELECT max(received_at) AS newest FROM log),
over AS (
  SELECT *, coalesce(told, CASE WHEN silent <= newest THEN silent END) AS resolved_at FROM ended, last)
SELECT o.fingerprint, o.episode_no, o.alert_type, o.severity, o.message, o.source,
  CASE WHEN e.resolved_at IS NULL THEN 'FIRING' ELSE 'RESOLVED' END AS status, o.created_at, e.resolved_at
FROM numbered o JOIN over e USING (fingerprint, episode_no)
WHERE o.status = 'FIRING' AND NOT o.was_open"""

    # Reports.
    out["recent_readings"] = _with(tagged) + f"""
SELECT customer_id, heart_rate, status, is_late, {_rounded('lateness_seconds', 1)} AS late_s,
  event_time FROM raw ORDER BY ingestion_time DESC, event_id DESC LIMIT 15"""
    out["recent_windows"] = _with(tagged) + f"""
SELECT customer_id, window_start, event_count, {_rounded('average_heart_rate', 1)} AS avg,
  minimum_heart_rate AS min, maximum_heart_rate AS max, abnormal_count, is_finalized
FROM daily ORDER BY window_start DESC, customer_id LIMIT 15"""
    out["late_summary"] = _with(tagged) + f"""
SELECT count(*) FILTER (WHERE is_late) AS late, count(*) AS total,
  {_rounded('max(lateness_seconds)', 1)} AS worst_lateness FROM raw"""
    reconciled = """,
counts AS (SELECT customer_id, window_start, count(*) AS raw_rows FROM raw GROUP BY 1, 2)"""
    out["reconcile_windows"] = _with(tagged) + reconciled + """
SELECT customer_id, CAST(window_start AS DATE) AS "window", event_count AS aggregated,
  raw_rows AS raw, event_count = raw_rows AS reconciles
FROM daily JOIN counts USING (customer_id, window_start) WHERE NOT is_finalized
ORDER BY customer_id, window_start LIMIT 10"""
    out["reconcile_summary"] = _with(tagged) + reconciled + """
SELECT count(*) AS open_windows, count(*) FILTER (WHERE event_count = raw_rows) AS reconciling
FROM daily JOIN counts USING (customer_id, window_start) WHERE NOT is_finalized"""
    out["reconcile_all"] = _with(tagged) + reconciled + """
SELECT customer_id, CAST(window_start AS DATE) AS "window", event_count AS aggregated,
  raw_rows AS raw, coalesce(event_count = raw_rows, FALSE) AS reconciles
FROM daily FULL JOIN counts USING (customer_id, window_start)"""
    out["fault_breakdown"] = _with(tagged) + f"""
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'NORMAL') AS normal,
  count(*) FILTER (WHERE status = 'ABNORMAL') AS abnormal, count(*) FILTER (WHERE is_late) AS late,
  count(*) FILTER (WHERE lateness_seconds > 3600) AS extreme_late,
  {_rounded('max(lateness_seconds)', 0)} AS worst_late_s FROM raw"""
    out["duplicate_check"] = _with(tagged) + """
SELECT count(*) AS stored, count(DISTINCT event_id) AS distinct_ids,
  count(*) - count(DISTINCT event_id) AS duplicate_rows, 'deliveries' AS table_name FROM deliveries
UNION ALL
SELECT count(*), count(DISTINCT event_id), count(*) - count(DISTINCT event_id), 'raw' FROM raw"""
    out["delivery_counters"] = _with(tagged) + """
SELECT tick, count(*) AS processed,
  count(*) FILTER (WHERE is_new AND status = 'ABNORMAL') AS abnormal,
  count(*) FILTER (WHERE NOT is_new) AS duplicates,
  count(*) FILTER (WHERE late_outcome = 'aggregated') AS late_aggregated,
  count(*) FILTER (WHERE late_outcome = 'finalized') AS late_finalized,
  count(*) FILTER (WHERE late_outcome = 'duplicate') AS late_duplicate
FROM outcomes GROUP BY tick"""
    out["customer_history"] = _with(tagged) + """
SELECT event_id, heart_rate, status, event_time, is_late FROM raw
WHERE customer_id = 'customer-7' ORDER BY event_time"""
    out["customer_windows"] = _with(tagged) + """
SELECT window_start, event_count, average_heart_rate, is_finalized FROM daily
WHERE customer_id = 'customer-7' ORDER BY window_start"""
    out["abnormal_in_range"] = _with(tagged) + """
SELECT customer_id, count(*) AS abnormal, max(heart_rate) AS highest FROM raw
WHERE status = 'ABNORMAL' AND event_time >= TIMESTAMP '2024-01-10 00:00:00'
  AND event_time < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1"""
    out["raw_retention"] = _with(tagged) + """
SELECT status, count(*) AS events, min(event_time) AS oldest FROM raw
WHERE event_time >= (SELECT max(event_time) FROM readings) - INTERVAL 7 DAYS GROUP BY 1"""
    raw_rules = {
        "heart_rate_range": "heart_rate BETWEEN 20 AND 250",
        "status_values": "TRUE",
        **{f"{c}_not_null": f"{c} IS NOT NULL" for c in
           ("event_id", "customer_id", "heart_rate", "event_time")},
        "status_not_null": "TRUE",
    }
    out["raw_checks"] = _with(deliveries_cte()) + """,
stored AS (SELECT event_id, customer_id, heart_rate, event_time FROM all_readings
  UNION ALL SELECT event_id, customer_id, heart_rate, event_time FROM deliveries)
""" + _checks(raw_rules, "stored") + """
UNION ALL SELECT 'event_id_unique', count(*) - count(DISTINCT event_id) FROM stored"""
    daily_rules = {
        "heart_rate_range": "minimum_heart_rate BETWEEN 20 AND 250 "
                            "AND maximum_heart_rate BETWEEN 20 AND 250",
        "minimum_at_most_maximum": "minimum_heart_rate <= maximum_heart_rate",
        "abnormal_at_most_count": "abnormal_count <= event_count",
        **{f"{c}_not_null": f"{c} IS NOT NULL" for c in
           ("customer_id", "window_start", "window_end", "event_count")},
    }
    out["daily_checks"] = _with(tagged) + _checks(daily_rules, "daily") + """
UNION ALL SELECT 'window_unique', count(*) - count(DISTINCT (customer_id, window_start)) FROM daily"""
    out["window_lookup"] = _with(tagged) + """
SELECT customer_id, window_start, event_count, is_finalized FROM daily
WHERE (customer_id, window_start) IN (
  SELECT (customer_id, window_start) FROM late WHERE tick = (SELECT max(tick) FROM late))"""
    out["latest_states"] = _with(tagged) + """,
states AS (SELECT customer_id, window_start, tick, count(*) AS event_count,
  CAST(sum(heart_rate) AS BIGINT) AS heart_rate_sum FROM late WHERE is_new GROUP BY 1, 2, 3)
SELECT * FROM states QUALIFY row_number() OVER (
  PARTITION BY customer_id, window_start ORDER BY tick DESC) = 1"""

    # Metrics.
    histogram = BUCKETS + """,
counts AS (SELECT event_type, le, shown, count(*) FILTER (WHERE value / 100 <= le) AS n
  FROM events CROSS JOIN bounds GROUP BY ALL)"""
    out["latency_histogram"] = _with(histogram) + """
SELECT event_type, shown AS le, n AS count FROM counts"""
    out["latency_quantiles"] = _with(
        histogram, quantile_cte("answers", "counts", "0.5, 0.95, 0.99", "event_type")
    ) + """
SELECT event_type, CAST(q AS DOUBLE) AS q, round(value, 9) AS value FROM answers"""
    out["partition_backlog"] = _with(deliveries_cte()) + """
SELECT 'heart-rate-events' AS topic, e.src_partition AS "partition",
  greatest(0, e.hi + 1 - (p.hi + 1)) AS lag
FROM (SELECT src_partition, max(seq) AS hi FROM all_readings GROUP BY 1) e
JOIN (SELECT src_partition, max(seq) AS hi FROM deliveries
      WHERE seq <= (SELECT max(seq) // 2 FROM deliveries) GROUP BY 1) p USING (src_partition)"""
    out["partition_load"] = _with(deliveries_cte()) + """
SELECT src_partition, count(*) AS events,
  round(count(*) / (SELECT count(*) FROM deliveries), 9) AS share FROM deliveries GROUP BY 1"""
    long_rates, short_rates = rates_cte("long_rates", 6), rates_cte("short_rates", 3)
    out["counter_rates"] = _with(SAMPLES, long_rates) + f"""
SELECT instance, {_at('step')} AS eval_ts, round(rate, 9) AS value FROM long_rates
WHERE name = 'processed'"""
    out["counter_increase"] = _with(SAMPLES, long_rates) + f"""
SELECT label AS aggregated, {_at('step')} AS eval_ts, sum(grown) AS value FROM long_rates
WHERE name = 'late' GROUP BY label, step"""
    out["latency_p95"] = _with(
        SAMPLES, long_rates, LATENCY_RATES, quantile_cte("p95", "bucket_rates", "0.95")
    ) + f"""
SELECT {_at('step')} AS eval_ts, round(value, 9) AS value FROM p95"""
    now3 = now_cte("now3", 3)
    out["gauge_summary"] = _with(SAMPLES, now3) + f"""
SELECT {_at('step')} AS eval_ts, round(sum(value), 9) AS total, round(max(value), 9) AS highest,
  round(min(value), 9) AS lowest, count(*) AS instances FROM now3 WHERE name = 'lag' GROUP BY step"""
    out["absent_steps"] = _with(SAMPLES, CONDITIONS) + f"""
SELECT {_at('step')} AS eval_ts, 1.0::DOUBLE AS value FROM spine
WHERE step NOT IN (SELECT step FROM now1 WHERE name = 'up')"""
    out["dead_letter_share"] = _with(SAMPLES, CONDITIONS) + f"""
SELECT {_at('step')} AS eval_ts, round(value, 9) AS value FROM shares"""

    quantiles = quantile_cte("latency", "bucket_rates", "0.5, 0.95, 0.99")
    panels = """,
totals AS (SELECT step, name, sum(value) AS value FROM now3 GROUP BY 1, 2),
rates AS (SELECT step, name, sum(rate) AS value FROM short_rates GROUP BY 1, 2)"""
    base = _with(SAMPLES, short_rates, long_rates, now3, LATENCY_RATES, quantiles) + panels
    last = "step = (SELECT max(scrape) FROM samples)"
    out["throughput_summary"] = base + " UNION ALL ".join([
        *[f"\nSELECT '{n}' AS name, round(value, 9) AS value FROM rates "
          f"WHERE name = '{m}' AND {last}"
          for n, m in (("processed/sec", "processed"), ("failed/sec", "failed"),
                       ("abnormal/sec", "abnormal"), ("late/sec", "late"))],
        *[f"\nSELECT 'p{int(q * 100)} latency (s)', round(value, 9) FROM latency "
          f"WHERE q = {q} AND {last}" for q in (0.5, 0.95, 0.99)],
        f"\nSELECT 'watermark lag (s)', round(max(value), 9) FROM now3 "
        f"WHERE name = 'lag' AND {last} HAVING count(*) > 0",
        f"\nSELECT 'windows open', round(sum(value), 9) FROM now3 "
        f"WHERE name = 'open' AND {last} HAVING count(*) > 0",
        f"\nSELECT 'consumer instances', count(*)::DOUBLE FROM now3 "
        f"WHERE name = 'up' AND value = 1 AND {last} HAVING count(*) > 0",
    ])
    feeds = " UNION ALL ".join([
        *[f"SELECT '{panel}' AS panel, '{legend}' AS legend, value FROM totals WHERE name = '{m}'"
          for panel, legend, m in (
              ("Messages processed", "processed", "processed"), ("DLQ events", "dlq", "letters"),
              ("Abnormal events", "abnormal", "abnormal"), ("Late events", "late", "late"),
              ("Windows", "open", "open"), ("Windows", "finalized (cumulative)", "closed"))],
        "SELECT 'Messages per second', 'processed/sec', value FROM rates WHERE name = 'processed'",
        "SELECT 'Messages per second', 'failed/sec', value FROM rates WHERE name = 'failed'",
        "SELECT 'Processing latency', 'p' || CAST(CAST(q * 100 AS INTEGER) AS VARCHAR), value "
        "FROM latency",
        "SELECT 'Watermark lag', 'lag ' || instance, value FROM now3 WHERE name = 'lag'",
        "SELECT 'Late events by aggregate outcome', 'aggregated=' || label, sum(increased) "
        "FROM long_rates WHERE name = 'late' GROUP BY label, step",
    ])
    out["dashboard_feeds"] = base + f""",
points AS ({feeds})
SELECT panel, legend, count(value) AS points, round(sum(value), 4) AS total,
  round(max(value), 9) AS peak
FROM points GROUP BY panel, legend"""

    # Alerts.
    conditions = _with(SAMPLES, CONDITIONS)
    out["alert_evaluations"] = conditions + """
SELECT alertname, severity, component, instance, count(*) FILTER (WHERE state = 'pending') AS pending,
  count(*) FILTER (WHERE state = 'firing') AS firing FROM alerts GROUP BY 1, 2, 3, 4"""
    out["alert_intervals"] = conditions + f"""
SELECT alertname, severity, component, instance, {_at('since')} AS active_at,
  {_at("min(step) FILTER (WHERE state = 'firing')")} AS fired_at,
  {_at('(max(step) + 1)')} AS ended_at
FROM alerts GROUP BY alertname, severity, component, instance, since"""
    out["stream_alert_intervals"] = out["alert_intervals"]
    out["default_limit_intervals"] = out["alert_intervals"].replace("value > 4.5", "value > 0.5").replace(
        "value > 0.3617", "value > 0.05").replace("v > 600", "v > 900")
    out["rule_history"] = conditions + f""",
runs AS (
  SELECT alertname, severity, component, instance, since, max(step) + 1 AS ended,
    min(step) FILTER (WHERE state = 'firing') AS fired
  FROM alerts GROUP BY alertname, severity, component, instance, since)
SELECT concat_ws('|', alertname, severity, component, instance) AS fingerprint,
  CAST(row_number() OVER (PARTITION BY alertname, severity, component, instance ORDER BY fired)
    AS BIGINT) AS episode_no, alertname AS alert_type, severity,
  CASE WHEN ended <= hi THEN 'RESOLVED' ELSE 'FIRING' END AS status,
  {_at('fired')} AS created_at, CASE WHEN ended <= hi THEN {_at('ended')} END AS resolved_at
FROM runs CROSS JOIN span WHERE fired IS NOT NULL"""
    out["rule_states"] = conditions + """
SELECT r.alertname, r.severity, coalesce(min(a.state), 'inactive') AS state
FROM (VALUES ('ConsumerDown', 'CRITICAL'), ('PostgresUnavailable', 'CRITICAL'),
  ('KafkaLagHigh', 'WARNING'), ('ProcessingLatencyHigh', 'WARNING'), ('DLQRateHigh', 'WARNING'),
  ('WatermarkStuck', 'WARNING')) r(alertname, severity)
LEFT JOIN alerts a ON a.alertname = r.alertname
  AND a.step = (SELECT (lo + hi) // 2 FROM span) GROUP BY 1, 2"""
    out["uninhibited_alerts"] = conditions + f"""
SELECT alertname, component, instance, {_at('step')} AS eval_ts FROM kept"""
    out["grouped_alerts"] = conditions + f"""
SELECT alertname, component, severity, alerts, {_at('oldest')} AS oldest, {_at('step')} AS eval_ts
FROM grouped"""
    # Looks every minute from `wait` seconds on, each at the state of its step.
    out["notification_schedule"] = conditions + """,
runs AS (
  SELECT *, min(step) OVER (PARTITION BY alertname, component, island) AS since FROM (
    SELECT *, step - row_number() OVER (PARTITION BY alertname, component ORDER BY step) AS island
    FROM grouped)),
looks AS (
  SELECT r.*, since * 600 + CASE WHEN severity = 'CRITICAL' THEN 5 ELSE 10 END + m.k * 60
      + (step - since) * 600 AS look_at
  FROM runs r CROSS JOIN range(10) m(k)),
compared AS (
  SELECT *, row_number() OVER w AS number, lag(members) OVER w AS before FROM looks
  WINDOW w AS (PARTITION BY alertname, component, since ORDER BY look_at)),
changed AS (
  SELECT *, CASE WHEN number = 1 THEN 'first' WHEN before <> members THEN 'changed' END AS change
  FROM compared),
anchored AS (
  SELECT *, max(CASE WHEN change IS NOT NULL THEN look_at END) OVER (
    PARTITION BY alertname, component, since ORDER BY look_at ROWS UNBOUNDED PRECEDING) AS anchor
  FROM changed),
sent AS (
  SELECT *, coalesce(change, CASE WHEN (look_at - anchor)
      % (CASE WHEN severity = 'CRITICAL' THEN 1800 ELSE 3600 END) = 0 THEN 'repeat' END) AS reason
  FROM anchored)
SELECT alertname, component, severity, alerts, reason, make_timestamp(since * 600000000)
    AS group_since, make_timestamp(look_at * 1000000) AS notify_at,
  CASE WHEN severity = 'CRITICAL' THEN 'critical' ELSE 'default' END AS route
FROM sent WHERE reason IS NOT NULL"""
    out["auto_resolved"] = """
WITH gaps AS (
  SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 10800 SECONDS THEN 0 ELSE 1 END AS s
  FROM (SELECT DISTINCT user_id, ts FROM events WHERE event_type = 'error')
  WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
runs AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM gaps)
SELECT user_id AS fingerprint, min(ts) AS started_at, count(*) AS updates,
  max(ts) + INTERVAL 10800 SECONDS AS resolved_at
FROM runs GROUP BY user_id, run"""

    log = _with(ALERT_LOG)
    out["parsed_alerts"] = log + """
SELECT arrival, CAST(position AS BIGINT) AS position, fingerprint, alert_type, severity, message,
  source, status, created_at, CAST(label_count AS BIGINT) AS label_count FROM log"""
    out["notification_history"] = log + "SELECT * FROM history"
    out["alert_transitions"] = log + """
SELECT arrival, CAST(position AS BIGINT) AS position, fingerprint, status, transition, episode_no
FROM tagged"""
    out["recent_notifications"] = log + """
SELECT fingerprint, episode_no, alert_type, severity, status, created_at, resolved_at FROM history
ORDER BY created_at DESC, fingerprint, episode_no LIMIT 20"""
    out["notifications_since"] = log + """
SELECT alert_type, severity, status, created_at, resolved_at FROM history
WHERE created_at > (SELECT max(ts) FROM events) - INTERVAL 10 DAYS"""
    out["notifications_of_type"] = log + """
SELECT fingerprint, episode_no, status, created_at FROM history
WHERE alert_type = 'DLQ_RATE_HIGH' AND created_at >= TIMESTAMP '2024-01-10 00:00:00'
  AND created_at < TIMESTAMP '2024-01-20 00:00:00'"""
    out["alert_counters"] = log + """
SELECT count(*) FILTER (WHERE status = 'FIRING') AS received_firing,
  count(*) FILTER (WHERE status = 'RESOLVED') AS received_resolved,
  count(*) FILTER (WHERE transition <> 'ignored') AS persisted,
  count(*) FILTER (WHERE transition = 'ignored') AS duplicates_ignored FROM tagged"""
    notification_rules = {
        "severity_values": "severity IN ('CRITICAL', 'WARNING', 'INFO')",
        "status_values": "status IN ('FIRING', 'RESOLVED')",
        "resolved_has_time": "(status = 'RESOLVED') = (resolved_at IS NOT NULL)",
        **{f"{c}_not_null": f"{c} IS NOT NULL" for c in
           ("fingerprint", "alert_type", "message", "created_at")},
    }
    out["notification_checks"] = log + _checks(notification_rules, "history") + """
UNION ALL SELECT 'one_open_per_fingerprint', count(*) - count(DISTINCT fingerprint)
FROM history WHERE status = 'FIRING'"""
    out["open_then_close"] = log + """,
half AS (SELECT max(event_id) // 2 AS middle FROM events),
standing AS (
  SELECT fingerprint FROM (
    SELECT fingerprint, arg_max(status, arrival * 10 + position) AS status
    FROM log, half WHERE arrival <= middle GROUP BY 1) WHERE status = 'FIRING')
SELECT fingerprint, 'RESOLVED' AS status, min(received_at) AS resolved_at FROM log, half
WHERE arrival > middle AND status = 'RESOLVED' AND fingerprint IN (SELECT fingerprint FROM standing)
GROUP BY 1
UNION ALL
SELECT fingerprint, 'OPENED', min(received_at) FROM log, half
WHERE arrival > middle AND status = 'FIRING'
  AND fingerprint NOT IN (SELECT fingerprint FROM standing) GROUP BY 1"""
    return out


def _flush_every_event() -> str:
    """Ticks of a single delivery; no allowed lateness."""
    return tagged_cte(tick=1, lateness=0)
