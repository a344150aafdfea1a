"""The registered queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

from tidemark.plans.queries import END_AT, START_AT, TABLES, TRUNCATED_AT
from tidemark.plans.logs import PHASE

EVENT = 'segment, "offset", event_type, value, payload'

LOG = """log AS (
  SELECT CAST(user_id % 4 AS INTEGER) AS segment, event_id AS "offset",
         CAST(user_id AS VARCHAR) AS routing_key, ts AS event_time, props AS payload,
         event_type, value
  FROM events)"""

JITTERED = f"""{LOG},
jittered AS (
  SELECT segment, "offset", routing_key,
         event_time - to_hours(CAST(("offset" * 37) % 100 AS INTEGER)) AS event_time,
         CAST(epoch(date_trunc('hour', event_time)) AS BIGINT) // 3600 AS epoch
  FROM log)"""

# The lower bound after each epoch and the one in force during it; a silent segment keeps its newest time.
_BOUNDS = """,
newest AS (SELECT epoch, segment, max(event_time) AS newest FROM jittered GROUP BY ALL),
carried AS (
  SELECT epoch, max(newest) OVER (PARTITION BY segment ORDER BY epoch) AS newest
  FROM (SELECT DISTINCT epoch FROM jittered) CROSS JOIN (SELECT DISTINCT segment FROM jittered)
  LEFT JOIN newest USING (epoch, segment)),
per_epoch AS (SELECT epoch, min(newest) AS least FROM carried GROUP BY epoch),
bounds AS (
  SELECT epoch, max(least) OVER (ORDER BY epoch) AS bound,
         max(least) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS in_force
  FROM per_epoch)"""

BOUNDS = JITTERED + _BOUNDS


def _at(moment: str, log: str = "log") -> str:
    """The cut of a log at a moment."""
    return f"""(SELECT segment, coalesce(min("offset") FILTER (event_time >= TIMESTAMP '{moment}'),
                max("offset") + 1) AS "position" FROM {log} GROUP BY segment)"""


PHASES = f"""phases AS (
  SELECT *, CAST(o_totalprice AS DECIMAL(12,2)) AS price0,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) + CASE WHEN o_orderstatus = 'O' THEN 10 ELSE 0 END
              AS DECIMAL(12,2)) AS price1,
         epoch_ms(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) AS day_ms
  FROM orders),
changes AS (
  SELECT o_orderkey AS "offset", day_ms AS ingestion_ms, '+I' AS row_kind, 0 AS sub_order, o_orderkey,
         o_custkey, o_orderstatus, price0 AS o_totalprice, o_orderpriority FROM phases
  UNION ALL
  SELECT {PHASE} + o_orderkey, day_ms + 1000, '-U', 0, o_orderkey, o_custkey, o_orderstatus, price0,
         o_orderpriority FROM phases WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT {PHASE} + o_orderkey, day_ms + 1000, '+U', 1, o_orderkey, o_custkey, o_orderstatus, price1,
         o_orderpriority FROM phases WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT {2 * PHASE} + o_orderkey, day_ms + 2000, '-D', 0, o_orderkey, o_custkey, o_orderstatus, price1,
         o_orderpriority FROM phases WHERE o_orderpriority = '5-LOW')"""

READINGS = """readings AS (
  SELECT event_id AS "offset", CAST(i AS INTEGER) AS element_index, user_id AS u,
         CAST(json_extract_string(props, '$.k') AS BIGINT) + i AS k
  FROM events, range(3) AS r(i) WHERE i < user_id % 4)"""

# fire: the first turn, newer than the one of arrival, whose watermark has reached the event time.
KEPT = """
turns AS (SELECT epoch, in_force,
          coalesce(sum(CASE WHEN in_force IS NULL OR bound > in_force THEN 1 ELSE 0 END) OVER
          (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS turn FROM bounds),
marks AS (SELECT turn, min(in_force) AS in_force FROM turns WHERE turn > 0 GROUP BY turn),
arrivals AS (SELECT j.*, t.turn FROM jittered j JOIN turns t USING (epoch)),
reached AS (SELECT event_time, (SELECT min(m.turn) FROM marks m WHERE m.in_force >= d.event_time) AS turn
            FROM (SELECT DISTINCT event_time FROM arrivals) d),
fired AS (SELECT a.routing_key, a.event_time, greatest(a.turn + 1, r.turn) AS fire
          FROM arrivals a JOIN reached r USING (event_time) WHERE r.turn IS NOT NULL),
kept AS (SELECT a.* FROM arrivals a WHERE NOT EXISTS (
         SELECT 1 FROM fired f WHERE f.routing_key = a.routing_key AND f.fire <= a.turn
         AND f.event_time >= a.event_time))"""

PLACE = """row_number() OVER (PARTITION BY routing_key ORDER BY event_time, "offset")"""

TEN_DAYS = JITTERED.replace("// 3600 AS epoch", "// 864000 AS epoch") + _BOUNDS

COPIED = "SELECT event_id, ts AS event_time, event_type, props AS payload FROM events"

CHANGED = """SELECT "offset", row_kind, sub_order, o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  o_orderpriority FROM changes"""

# The JSON-schema types of the given tables' columns.
_N, _S, _T, _A = (
    '{"type": "number"}',
    '{"type": "string"}',
    '{"type": "string", "format": "date-time"}',
    '{"type": "array"}',
)
_COLUMNS = {
    "region": {"r_regionkey": _N, "r_name": _S},
    "nation": {"n_nationkey": _N, "n_name": _S, "n_regionkey": _N},
    "customer": {"c_custkey": _N, "c_name": _S, "c_nationkey": _N, "c_acctbal": _N, "c_mktsegment": _S},
    "supplier": {"s_suppkey": _N, "s_name": _S, "s_nationkey": _N, "s_acctbal": _N},
    "part": {"p_partkey": _N, "p_name": _S, "p_brand": _S, "p_type": _S, "p_size": _N, "p_retailprice": _N},
    "orders": {
        "o_orderkey": _N,
        "o_custkey": _N,
        "o_orderstatus": _S,
        "o_totalprice": _N,
        "o_orderdate": _T,
        "o_orderpriority": _S,
    },
    "lineitem": {
        "l_orderkey": _N,
        "l_partkey": _N,
        "l_suppkey": _N,
        "l_linenumber": _N,
        "l_quantity": _N,
        "l_extendedprice": _N,
        "l_discount": _N,
        "l_tax": _N,
        "l_returnflag": _S,
        "l_linestatus": _S,
        "l_shipdate": _T,
    },
    "events": {"event_id": _N, "ts": _T, "user_id": _N, "event_type": _S, "value": _N, "props": _S},
    "documents": {"doc_id": _N, "text": _S, "lang": _S, "source": _S, "n_chars": _N},
    "embeddings": {"vec_id": _N, "embedding": _A, "label": _N},
    "pages": {"page_id": _N, "url": _S, "html": _S},
    "benchmark": {"item_id": _N, "text": _S},
    "labels": {"doc_id": _N, "quality": _N, "toxic": _N},
    "conversations": {"conv_id": _N, "turn": _N, "role": _S, "text": _S},
}


def _schema_rows() -> str:
    rows = []
    for name in TABLES:
        fields = ", ".join(f'"{column}": {kind}' for column, kind in _COLUMNS[name].items())
        text = '{"title": "Json Schema", "type": "object", "properties": {' + fields + "}}"
        rows.append(f"SELECT '{name}' AS table_name, '{text}' AS json_schema, count(*) AS n_rows FROM {name}")
    return " UNION ALL ".join(rows)


def _per_key(key: str) -> str:
    return (f"SELECT {key} AS routing_key, CAST(1 AS BIGINT) AS n_segments, count(*) AS n_events, true AS spread "
            "FROM events GROUP BY 1")


ORACLE = {
    "stream_scan_full": f"WITH {LOG} SELECT {EVENT} FROM log",
    "scan_from_cut": f"""WITH {LOG} SELECT {EVENT} FROM log JOIN {_at(START_AT)} lo USING (segment)
        WHERE "offset" >= lo."position" """,
    "scan_cut_range": f"""WITH {LOG} SELECT {EVENT} FROM log JOIN {_at(START_AT)} lo USING (segment)
        JOIN {_at(END_AT)} hi USING (segment)
        WHERE "offset" >= lo."position" AND "offset" < hi."position" """,
    "truncated_scan": f"""WITH {LOG} SELECT {EVENT} FROM log JOIN {_at(TRUNCATED_AT)} lo USING (segment)
        JOIN {_at(END_AT)} hi USING (segment)
        WHERE "offset" >= lo."position" AND "offset" < hi."position" """,
    "multi_stream_union": f"""WITH {LOG}
        SELECT CASE WHEN event_type IN ('click', 'view') THEN 'web' ELSE 'shop' END AS scope,
               CASE WHEN event_type IN ('click', 'view') THEN 'browsing' ELSE 'deeds' END AS stream,
               {EVENT} FROM log""",
    "multi_stream_cuts": f"""WITH {LOG},
        browsing AS (SELECT * FROM log WHERE event_type IN ('click', 'view')),
        deeds AS (SELECT * FROM log WHERE event_type NOT IN ('click', 'view'))
        SELECT 'web' AS scope, 'browsing' AS stream, {EVENT} FROM browsing
        JOIN {_at(START_AT, "browsing")} lo USING (segment) JOIN {_at(END_AT, "browsing")} hi USING (segment)
        WHERE "offset" >= lo."position" AND "offset" < hi."position"
        UNION ALL
        SELECT 'shop', 'deeds', {EVENT} FROM deeds JOIN {_at(START_AT, "deeds")} hi USING (segment)
        WHERE "offset" < hi."position" """,
    "cut_text_roundtrip": f"""WITH {LOG},
        tails AS (SELECT event_type, segment, max("offset") + 1 AS "offset" FROM log GROUP BY ALL),
        texts AS (SELECT event_type, to_base64(encode('{{' || string_agg('"' || segment || '":' || "offset", ','
                  ORDER BY segment) || '}}')) AS cut_text FROM tails GROUP BY event_type)
        SELECT event_type, cut_text, segment, "offset" FROM tails JOIN texts USING (event_type)""",
    "tail_cut": f"""WITH {LOG} SELECT segment, max("offset") + 1 AS "offset" FROM log GROUP BY segment""",
    "unread_backlog": f"""WITH {LOG} SELECT segment, count(*) AS unread_events,
        CAST(sum(strlen(payload)) AS BIGINT) AS unread_bytes FROM log JOIN {_at(START_AT)} lo USING (segment)
        WHERE "offset" >= lo."position" GROUP BY segment""",
    "eos_marker_cut": f"""WITH {LOG},
        ends AS (SELECT segment, min("offset") AS eos FROM log WHERE event_type = 'error' AND value > 250
                 GROUP BY segment)
        SELECT {EVENT} FROM log LEFT JOIN ends USING (segment) WHERE eos IS NULL OR "offset" < eos""",
    "event_pointer_projection": f"""WITH {LOG} SELECT routing_key, value,
        '{{"scope":"s","stream":"events","segment":' || segment || ',"offset":' || "offset" || '}}'
        AS event_pointer, event_type FROM log""",
    "pointer_fetch": f"""WITH {LOG} SELECT routing_key, {EVENT} FROM log
        QUALIFY row_number() OVER (PARTITION BY routing_key ORDER BY value DESC, "offset" DESC) = 1""",
    "decode_json": f"""WITH {LOG} SELECT segment, "offset",
        CAST(json_extract_string(payload, '$.k') AS INTEGER) AS k FROM log""",
    "decode_json_lenient": f"""WITH {LOG} SELECT segment, "offset",
        CAST(json_extract_string(payload, '$.k') AS INTEGER) AS k FROM log WHERE event_type <> 'error'""",
    "decode_registered": f"""WITH {LOG} SELECT segment, "offset",
        CAST(json_extract_string(payload, '$.k') AS BIGINT) AS k FROM log""",
    "decode_text_int": """SELECT event_id AS "offset", event_type AS text_value,
        CAST(CASE WHEN event_type = 'error' THEN -round(value * 100) ELSE round(value * 100) END AS INTEGER)
        AS int_value FROM events""",
    "decode_explode": f'WITH {READINGS} SELECT "offset", element_index, u, k FROM readings',
    "assign_timestamps": f"""WITH {READINGS} SELECT "offset", k, "offset" * 1000 + element_index AS ts_ms
        FROM readings""",
    "encode_json": """SELECT event_id AS "offset", '{"routing_key":"' || user_id || '","event_time":"'
        || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","value":' || CAST(value AS DECIMAL(10,2)) || '}'
        AS payload FROM events""",
    "computed_columns": """SELECT event_id AS "offset", CAST(value AS DECIMAL(10,2)) AS price,
        CAST(CAST(value AS DECIMAL(10,2)) + 1.0 AS DECIMAL(12,2)) AS computed_price,
        CAST(ts AS DATE) AS log_date, ts + INTERVAL 1 SECOND AS log_ts, ts - INTERVAL 5 SECOND AS bound
        FROM events""",
    "tumbling_window_agg": """SELECT date_trunc('hour', ts + INTERVAL 1 SECOND) + INTERVAL 1 HOUR AS window_end,
        max(CAST(ts AS DATE)) AS max_date, max(ts + INTERVAL 1 SECOND) AS max_ts, count(*) AS n,
        max(value) AS max_value FROM events GROUP BY 1""",
    "window_tag": f"""WITH {LOG} SELECT segment, "offset", date_trunc('day', event_time) AS window_start,
        date_trunc('day', event_time) + INTERVAL 1 DAY AS window_end FROM log""",
    "count_distinct": "SELECT event_type, count(DISTINCT user_id) AS n_keys FROM events GROUP BY 1",
    "word_count_window": """WITH words AS (
        SELECT TIMESTAMP '1970-01-01' + to_seconds(doc_id - doc_id % 10) AS window_start,
               unnest(regexp_split_to_array(text, '[ \\t\\r\\n]+')) AS word FROM documents)
        SELECT window_start, word, count(*) AS n FROM words WHERE word <> '' GROUP BY ALL""",
    "cdc_expand": f"WITH {PHASES} {CHANGED}",
    "cdc_metadata": f"""WITH {PHASES} SELECT "offset", row_kind, o_orderkey, ingestion_ms,
        'orders' AS origin_table FROM changes""",
    "changelog_sum": f"""WITH {PHASES} SELECT o_custkey, 'orders' AS origin_table,
        CAST(sum(price1) AS DECIMAL(22,2)) AS total_price, count(*) AS n_orders
        FROM phases WHERE o_orderpriority <> '5-LOW' GROUP BY o_custkey""",
    "changelog_latest": f"""WITH {PHASES} SELECT o_orderkey, o_custkey, o_orderstatus, price1 AS o_totalprice,
        o_orderpriority FROM phases WHERE o_orderpriority <> '5-LOW'""",
    "cdc_canal": f"WITH {PHASES} {CHANGED}",
    "append_only_split": f"""WITH {PHASES} SELECT row_kind, row_kind = '+I' AS accepted, count(*) AS n
        FROM changes GROUP BY ALL""",
    "route_by_key": _per_key("CAST(user_id AS VARCHAR)"),
    "route_by_expr": _per_key("event_type || '-' || json_extract_string(props, '$.k')"),
    "route_without_key": """SELECT CAST(i AS INTEGER) AS segment, true AS fair FROM range(16) AS r(i)
        WHERE EXISTS (SELECT * FROM events)""",
    "stream_names": """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'main' ELSE lang END AS scope,
        CASE WHEN doc_id % 3 = 2 THEN source || '/part' ELSE source END AS stream FROM documents""",
    "event_time_order": f"""WITH {JITTERED} SELECT routing_key, "offset", event_time,
        row_number() OVER (PARTITION BY routing_key ORDER BY event_time, "offset") AS "position"
        FROM jittered""",
    "lower_bound_watermark": f"""WITH {BOUNDS} SELECT epoch, bound AS watermark FROM bounds
        WHERE in_force IS NULL OR bound > in_force""",
    "watermark_marks": f"""WITH {BOUNDS},
        totals AS (SELECT epoch, max(event_time) AS newest, count(*) AS n_rows FROM jittered GROUP BY epoch),
        eligible AS (SELECT epoch, in_force AS watermark, n_rows FROM totals JOIN bounds USING (epoch)
                     WHERE newest >= in_force)
        SELECT epoch, watermark, n_rows FROM (
          SELECT *, max(watermark) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 AS noted FROM eligible)
        WHERE noted IS NULL OR watermark > noted""",
    "late_drop_replay": f"""WITH {BOUNDS}, {KEPT}
        SELECT routing_key, "offset", event_time, {PLACE} AS "position" FROM kept""",
    "append_roundtrip": COPIED,
    "ordered_write": f"""WITH {JITTERED} SELECT routing_key, "offset" AS event_id, event_time,
        row_number() OVER (PARTITION BY routing_key ORDER BY event_time, "offset") AS "position"
        FROM jittered""",
    "sink_at_least_once": "SELECT event_id, CAST(2 AS BIGINT) AS copies FROM events",
    "sink_exactly_once": "SELECT event_id, event_type, props AS payload FROM events",
    "sink_best_effort": """WITH batches AS (
          SELECT event_id, event_type, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) // 10 AS batch FROM events)
        SELECT event_id, event_type, CAST(1 AS BIGINT) AS lost_batches FROM batches
        WHERE batch <> (SELECT DISTINCT batch FROM batches ORDER BY batch LIMIT 1 OFFSET 1)""",
    "sink_watermark": """SELECT count(*) AS n_rows, epoch_us(max(ts)) AS watermark, CAST(0 AS BIGINT) AS falls
        FROM events""",
    "commit_replay": """SELECT 'daily' AS query_id,
        CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) // 10 AS BIGINT) AS batch_id, count(*) AS n_rows
        FROM events GROUP BY 2""",
    "watermark_in_force": f"""WITH {TEN_DAYS},
        totals AS (SELECT epoch, max(event_time) AS newest, count(*) AS n_rows FROM jittered GROUP BY epoch),
        eligible AS (SELECT epoch, in_force, n_rows FROM totals JOIN bounds USING (epoch) WHERE newest >= in_force)
        SELECT epoch_us(in_force) AS watermark, n_rows FROM (
          SELECT *, max(in_force) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 AS noted FROM eligible)
        WHERE noted IS NULL OR in_force > noted""",
    "bounded_stream_read": f"""{COPIED} WHERE date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) // 10
        < (SELECT max(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) // 10) FROM events)""",
    "stored_tail_cut": f"""WITH parts AS (
          SELECT CAST(CASE WHEN ts < TIMESTAMP '{START_AT}' THEN 1 WHEN ts < TIMESTAMP '{END_AT}' THEN 2 ELSE 3 END
                      AS BIGINT) AS epoch, strlen(event_type) + strlen(props) AS n FROM events),
        held AS (SELECT epoch, count(*) AS n_events, CAST(sum(n) AS BIGINT) AS n_bytes FROM parts GROUP BY epoch)
        SELECT epoch, n_events, n_bytes,
               CAST(coalesce(sum(n_events) OVER later, 0) AS BIGINT) AS unread_events,
               CAST(coalesce(sum(n_bytes) OVER later, 0) AS BIGINT) AS unread_bytes
        FROM held WINDOW later AS (ORDER BY epoch ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
    "stored_backlog": f"""SELECT count(*) AS unread_events,
        CAST(sum(strlen(event_type) + strlen(props)) AS BIGINT) AS unread_bytes
        FROM events WHERE ts >= TIMESTAMP '{TRUNCATED_AT}'""",
    "truncated_stream": f"""SELECT event_id, event_type, props AS payload FROM events
        WHERE ts >= TIMESTAMP '{TRUNCATED_AT}'""",
    "schema_evolved_read": f"""SELECT event_id, event_type AS kind,
        CASE WHEN ts < TIMESTAMP '{START_AT}' THEN CAST(user_id AS VARCHAR) ELSE 'u' || user_id END AS user,
        CASE WHEN ts >= TIMESTAMP '{START_AT}' THEN CAST(ts AS DATE) END AS day FROM events""",
    "encode_registered": """SELECT event_id, '{"user":"' || user_id || '","amount":' || CAST(value AS DECIMAL(10,2))
        || ',"kind":"' || event_type || '"}' AS payload FROM events""",
    "declared_table": """SELECT ts + INTERVAL 1 SECOND - INTERVAL 5 SECOND AS bound,
        CAST(CAST(value AS DECIMAL(10,2)) + 1.0 AS DECIMAL(12,2)) AS "computed-price",
        CAST(value AS DECIMAL(10,2)) AS price, CAST(user_id AS VARCHAR) AS owner, event_type AS currency,
        'prices' AS stream_name, CAST(ts AS DATE) AS log_date, ts AS log_ts, ts + INTERVAL 1 SECOND AS ts, event_id
        FROM events""",
    "delivery_audit": """SELECT 'missing' AS issue, count(*) AS n_values, CAST(0 AS BIGINT) AS n_copies FROM events
        WHERE event_type = 'purchase'
        UNION ALL SELECT 'duplicate', count(*), 2 * count(*) FROM events WHERE event_type = 'error'
        UNION ALL SELECT 'extra', count(DISTINCT user_id), count(DISTINCT user_id) FROM events""",
    "streaming_parity": """WITH w AS (
        SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type FROM events)
        SELECT epoch_us(window_end) AS window_end_us, event_type, count(*) AS n FROM w
        WHERE window_end <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) GROUP BY ALL""",
    "streaming_resume": COPIED,
    "event_time_order_stream": f"""WITH {TEN_DAYS}, {KEPT}
        SELECT routing_key, "offset" AS event_id, event_time, {PLACE} AS "position" FROM kept""",
    "catalog_tables": """SELECT DISTINCT lang AS database_name, source AS table_name FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "schema_latest": """WITH versions AS (
        SELECT event_type AS group_id,
               CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS version,
               '{"title": "v' || max(event_id) || '", "type": "object"}' AS schema FROM events GROUP BY ALL)
        SELECT * FROM versions
        QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY version DESC) = 1""",
    "schema_to_json": _schema_rows(),
}
