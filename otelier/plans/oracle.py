"""The derived telemetry once more, as flat SQL over the star-schema tables: what the operators are checked against.

Each constant is the text of one common table expression; `with_tables` puts the needed ones before a query.
"""

from __future__ import annotations

from otelier.plans.fixtures import BOUNDS, EXP_BUCKETS, LOGS_PER_PACKET, NEST_LEVELS, ORDERS_PER_PACKET, TURNS_PER_PACKET


def hx(number: str, digits: int) -> str:
    return f"lpad(lower(hex({number})), {digits}, '0')"


def nanos(time: str) -> str:
    return f"(epoch_us({time}) * 1000)"


def micros_text(ns: str) -> str:
    return f"strftime(make_timestamp({ns} // 1000), '%Y-%m-%d %H:%M:%S.%f')"


def millis_text(ns: str) -> str:
    return f"strftime(make_timestamp({ns} // 1000000 * 1000), '%Y-%m-%d %H:%M:%S.%g')"


SPANS = f"""
line AS (
  SELECT l_orderkey, l_linenumber, CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) AS qty
  FROM lineitem GROUP BY l_orderkey, l_linenumber
), spans AS (
  SELECT 'spans/' || o_custkey || '/' || (o_orderkey // {ORDERS_PER_PACKET}) AS batch, o_orderkey AS okey, 0 AS line,
    'shop-' || (o_custkey % 5) AS service, {hx('o_orderkey + 1', 32)} AS trace_id,
    {hx('(o_orderkey + 1) * 16', 16)} AS span_id, '' AS parent_span_id,
    'place_order' AS name, 'SPAN_KIND_SERVER' AS kind, {nanos('o_orderdate')} AS start_ns,
    {nanos('o_orderdate')} + CAST(floor(o_totalprice) AS BIGINT) * 1000 AS end_ns,
    CASE o_orderstatus WHEN 'F' THEN 'STATUS_CODE_ERROR' WHEN 'O' THEN 'STATUS_CODE_OK'
      ELSE 'STATUS_CODE_UNSET' END AS code,
    CASE WHEN o_orderkey % 2 = 0 THEN 'POST' END AS old_method,
    CASE WHEN o_orderkey % 2 = 1 THEN 'POST' END AS new_method,
    CAST(CASE o_orderstatus WHEN 'F' THEN 500 ELSE 200 END AS BIGINT) AS http_status,
    NULL AS rpc_method, NULL AS rpc_system, o_orderpriority AS priority
  FROM orders
  UNION ALL
  SELECT 'spans/' || o_custkey || '/' || (o_orderkey // {ORDERS_PER_PACKET}), o_orderkey, l_linenumber,
    'shop-' || (o_custkey % 5), {hx('o_orderkey + 1', 32)}, {hx('(o_orderkey + 1) * 16 + l_linenumber', 16)},
    {hx('(o_orderkey + 1) * 16', 16)}, 'line_' || l_linenumber, 'SPAN_KIND_CLIENT',
    {nanos('o_orderdate')} + l_linenumber * 1000000, {nanos('o_orderdate')} + (l_linenumber + qty) * 1000000,
    'STATUS_CODE_UNSET', NULL, NULL, NULL, 'pick', 'grpc', NULL
  FROM line JOIN orders ON l_orderkey = o_orderkey
)"""

LOGS = f"""
logs AS (
  SELECT 'logs/' || user_id || '/' || strftime(ts, '%Y-%m-%d') || '/' || (event_id // {LOGS_PER_PACKET}) AS batch,
    event_id, user_id, event_type, 'shop-' || (user_id % 5) AS service, {nanos('ts')} AS time_ns,
    CAST(CASE event_type WHEN 'error' THEN 17 ELSE 9 END AS BIGINT) AS severity_number,
    CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS severity_text,
    CASE event_type WHEN 'view' THEN 'INT_VALUE' ELSE 'STRING_VALUE' END AS body_type,
    CASE WHEN event_type <> 'view' THEN event_type END AS body_string,
    CASE WHEN event_type = 'view' THEN CAST(floor(value) AS BIGINT) END AS body_int,
    CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT) AS k,
    CASE WHEN event_type <> 'click' THEN {hx('event_id + 1', 32)} ELSE '' END AS trace_id,
    CASE WHEN event_type <> 'click' THEN {hx('(event_id + 1) * 16', 16)} ELSE '' END AS span_id
  FROM events
)"""


def _bucket(low, high) -> str:
    tests = [f"v > {int(low)}"] if low is not None else []
    tests += [f"v <= {int(high)}"] if high is not None else []
    return "count(*) FILTER (WHERE " + " AND ".join(tests) + ")"


_EDGES = (None, *BOUNDS, None)
N_BUCKETS = len(BOUNDS) + 1
LABELS = ["lt_500.0", "500.0-1000.0", "1000.0-2500.0", "2500.0-5000.0", "5000.0-7500.0", "7500.0-10000.0",
          "gt_10000.0"]

HOURS = f"""
ev AS (
  SELECT 'shop-' || (user_id % 3) AS service, event_type, date_trunc('hour', ts) AS h, event_id, value,
    CAST(round(value * 100) AS BIGINT) AS v, {nanos('ts')} AS at_ns
  FROM events
), hr AS (
  SELECT service, event_type, h, CAST(date_trunc('day', h) AS TIMESTAMP) AS d,
    count(*) AS n, CAST(sum(v) AS BIGINT) AS s, min(v) AS lo, max(v) AS hi, arg_max(value, event_id) AS last_value,
    min(event_id) AS x_id, arg_min(v, event_id) AS x_v, arg_min(at_ns, event_id) AS x_at,
    count(*) FILTER (WHERE v <= 1) AS zero,
    {', '.join(f'{_bucket(_EDGES[i], _EDGES[i + 1])} AS b{i}' for i in range(N_BUCKETS))},
    {', '.join(f'{_bucket(2 ** i, 2 ** (i + 1))} AS e{i}' for i in range(EXP_BUCKETS))}
  FROM ev GROUP BY service, event_type, h
), hours AS (
  SELECT *, 'metrics/' || service || '/' || strftime(d, '%Y-%m-%d') AS batch, 'app@' || service AS emitter,
    {nanos('d')} AS start_ns, {nanos('h')} + 3600000000000 AS time_ns,
    row_number() OVER (PARTITION BY service, d ORDER BY event_type, h) - 1 AS point,
    CAST(sum(n) OVER w AS BIGINT) AS cn, CAST(sum(s) OVER w AS BIGINT) AS cs,
    min(lo) OVER w AS clo, max(hi) OVER w AS chi,
    {', '.join(f'CAST(sum(b{i}) OVER w AS BIGINT) AS c{i}' for i in range(N_BUCKETS))}
  FROM hr WINDOW w AS (PARTITION BY service, event_type, d ORDER BY h)
)"""

# one row per data point of the five metrics, numbers where the kind has them
POINTS = HOURS + """,
points AS (
  SELECT batch, emitter, service, event_type, start_ns, time_ns, point, 1 AS seq_no, 'app.value.last' AS name,
    'GAUGE' AS type, last_value AS gauge_double, NULL AS sum_int, NULL AS cnt, NULL AS total, NULL AS lo, NULL AS hi
  FROM hours
  UNION ALL SELECT batch, emitter, service, event_type, start_ns, time_ns, point, 2, 'app.events', 'SUM',
    NULL, cn, NULL, NULL, NULL, NULL FROM hours
  UNION ALL SELECT batch, emitter, service, event_type, start_ns, time_ns, point, 3, 'app.value.dist', 'HISTOGRAM',
    NULL, NULL, cn, cs, clo, chi FROM hours
  UNION ALL SELECT batch, emitter, service, event_type, start_ns, time_ns, point, 4, 'app.value.exp',
    'EXPONENTIAL_HISTOGRAM', NULL, NULL, n, s, lo, hi FROM hours
  UNION ALL SELECT batch, emitter, service, event_type, start_ns, time_ns, point, 5, 'app.value.summary', 'SUMMARY',
    NULL, NULL, n, s, NULL, NULL FROM hours
)"""

# one row per statistic of a histogram point
STATS = HOURS + """,
stats AS (
""" + "\n  UNION ALL ".join(
    f"SELECT batch, emitter, event_type, start_ns, time_ns, '{label}' AS stat, CAST({col} AS DOUBLE) AS value FROM hours"
    for label, col in [("count", "cn"), ("sum", "cs"), ("min", "clo"), ("max", "chi"),
                       *[(LABELS[i], f"c{i}") for i in range(N_BUCKETS)]]) + "\n)"

PROFILES = f"""
turns AS (
  SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS chars, string_split(text, ' ') AS words,
    'profiles/' || conv_id || '/' || (turn // {TURNS_PER_PACKET}) AS batch, {hx('conv_id + 1', 32)} AS profile_id,
    {hx('(conv_id + 1) * 16', 16)} AS link_span, 'host-' || (conv_id // 10) AS host,
    row_number() OVER (PARTITION BY conv_id, turn // {TURNS_PER_PACKET} ORDER BY turn) - 1 AS sample,
    conv_id * 1000000000 AS start_ns, conv_id * 1000000000 + turn * 1000000 AS t0, role <> 'system' AS is_valid
  FROM conversations
), profile_rows AS (
  SELECT *, 0 AS value_no, chars AS value, CASE WHEN role <> 'assistant' THEN t0 END AS ts_ns FROM turns
  UNION ALL
  SELECT *, 1, CAST(len(words) AS BIGINT), CASE WHEN role = 'user' THEN t0 + 1 END FROM turns
)"""

FRAMES = PROFILES + """,
frames AS (
  SELECT *, unnest(words) AS word, unnest(range(len(words))) AS pos FROM profile_rows
)"""


# a customer's segment and key in lists (even levels) and dicts (odd ones), as plain JSON
_WRAPPED = "'\"' || c_mktsegment || '\"'"
for _level in range(2, NEST_LEVELS + 1):
    _inner = f"""'{{"k":' || ({_WRAPPED}) || '}}'""" if _level % 2 else f"'[' || ({_WRAPPED}) || ']'"
    _WRAPPED = f"CASE WHEN c_custkey % {NEST_LEVELS} + 1 >= {_level} THEN {_inner} ELSE {_WRAPPED} END"
NESTED = f"""
nested AS (
  SELECT CAST(c_custkey AS BIGINT) AS custkey, CAST(c_custkey % {NEST_LEVELS} + 1 AS BIGINT) AS levels,
    '[' || ({_WRAPPED}) || ',' || c_custkey || ']' AS v
  FROM customer
)"""


def with_tables(query: str, *tables: str) -> str:
    return "WITH " + ",\n".join(t.strip() for t in tables) + "\n" + query.strip()
