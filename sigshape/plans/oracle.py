"""DuckDB SQL computing each registered query's result straight from the base
tables (never by re-parsing the encoded text), so an encoder bug and a
parser bug cannot hide each other. Column names match the Spark queries.
"""

from __future__ import annotations

from .registry import (COMMITTED_SUBSET, DEDUP_CONF, SPLIT_CONF, STORED_POSITIONS, TOPIC_LIST)
from ..sources.records import topic_set
from ..sources.testtables import OFFSET_STEP, PART_BLOCK

# ---------------------------------------------------------------- fragments

# Sort order of list elements inside a wide line.
ELEM_ORDER = "l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_returnflag, l.l_linestatus"
NO_LINES = "NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = o.o_orderkey)"
HAS_LINES = "EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = o.o_orderkey)"

IMSI = "CAST(o.o_custkey AS VARCHAR)"
O_TS = "strftime(o.o_orderdate, '%Y%m%d%H%M%S')"

IN_COLS = {
    "imsi": IMSI,
    "region": "COALESCE(CAST(l.l_partkey AS VARCHAR), '')",
    "timestamp": O_TS,
    "city": "o.o_orderstatus",
    "county": "o.o_orderpriority",
    "usr_prov": "CAST(o.o_custkey % 31 AS VARCHAR)",
    "usr_city": "CAST(o.o_custkey % 97 AS VARCHAR)",
    "usr_county": "CAST(o.o_orderkey % 89 AS VARCHAR)",
    "sex": "CASE WHEN o.o_custkey % 2 = 0 THEN 'M' ELSE 'F' END",
    "age_level": "CAST(o.o_custkey % 7 AS VARCHAR)",
    "arpu_level": "CAST(o.o_orderkey % 5 AS VARCHAR)",
    "in_time": "COALESCE(strftime(l.l_shipdate, '%Y%m%d%H%M%S'), '')",
    "flag": ("CASE WHEN l.l_orderkey IS NULL THEN '' WHEN l.l_returnflag = 'A' THEN '0' "
             "WHEN l.l_returnflag = 'R' THEN '1' ELSE '9' END"),
}
OUT_COLS = {
    "imsi": IMSI,
    "region": "COALESCE(CAST(l.l_suppkey AS VARCHAR), '')",
    "timestamp": O_TS,
    "in_time": "COALESCE(strftime(l.l_shipdate, '%Y%m%d'), '')",
    "out_time": "COALESCE(CAST(l.l_linenumber AS VARCHAR), '')",
    "stay": "COALESCE(l.l_linestatus, '')",
    "out_city": "CAST(o.o_orderkey % 100 AS VARCHAR)",
    "out_county": "CAST(o.o_orderkey % 1000 AS VARCHAR)",
}
# A line of the fan-out holds the items of one order and one block of part keys.
UNIT = f"l.l_partkey // {PART_BLOCK}"
W_OFF = f"o.o_orderkey + coalesce({UNIT}, 0) * {OFFSET_STEP}"
WIDE_FROM = "FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey"


def _q(name: str) -> str:
    return f'"{name}"'


def _rows_sql(cols: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f"{e} AS {_q(n)}" for n, e in cols.items()) + " " + WIDE_FROM


def _messages_sql(cols: dict[str, str], topic: str) -> str:
    value = "concat_ws(',', " + ", ".join(cols.values()) + ")"
    return f"SELECT '{topic}' AS topic, {IMSI} AS key, {value} AS value {WIDE_FROM}"


# events-derived record columns
E_PART = "CAST(user_id % 4 AS INTEGER)"
E_OFF = "(event_id + 100)"
E_TIME = "strftime(ts, '%Y%m%d')"
E_LINE = ("concat_ws('|', CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR), props, "
          f"{E_TIME}, event_type, CAST(user_id % 7 AS VARCHAR))")
E_KEY = "CAST(user_id AS VARCHAR) || '_' || event_type || '_' || CAST(user_id % 7 AS VARCHAR)"
E_BATCH = "CAST(epoch_ms(ts) // 864000000 AS BIGINT)"
E_RECKEY = "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END"

EVENTS_KEYED = (f"SELECT {E_BATCH} AS batch_id, {E_KEY} AS key, {E_LINE} AS value, {E_TIME} AS t, "
                f"{E_PART} AS p, {E_OFF} AS o FROM events")


TIED = ("SELECT event_type, user_id, CAST(ts AS DATE) AS day, min(event_id) AS event_id FROM events GROUP BY 1, 2, 3")
TIED_KEYED = (f"SELECT CAST(year(ts) AS BIGINT) AS batch_id, CAST(user_id AS VARCHAR) || '_' || CAST(user_id % 7 AS VARCHAR) AS key, "
              f"{E_LINE} AS value, {E_TIME} AS t, event_type AS topic, {E_PART} AS p, "
              f"user_id * 1000 + dayofyear(ts) AS o FROM events WHERE event_id IN (SELECT event_id FROM ({TIED}) x)")


def _dedup_sql(order: str, keyed: str = EVENTS_KEYED) -> str:
    return ("SELECT batch_id, key, value FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY batch_id, key ORDER BY {order}) AS rn FROM ({keyed}) k) r WHERE rn = 1")


DEDUP_LATEST = _dedup_sql("t DESC, p DESC, o DESC")
DEDUP_ANY = _dedup_sql("p ASC, o ASC")
TIED_LATEST = _dedup_sql("t DESC, topic DESC, p DESC, o DESC", TIED_KEYED)
TIED_ANY = _dedup_sql("topic ASC, p ASC, o ASC", TIED_KEYED)

FIELD_EXPRS = [
    "CAST(event_id AS VARCHAR)",
    "CAST(user_id AS VARCHAR)",
    "event_type",
    "CASE WHEN event_id % 3 = 0 THEN '' ELSE props END",
    "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type END",
]
SPLIT_FIELDS = " UNION ALL ".join(
    f'SELECT {E_OFF} AS "offset", CAST({i} AS INTEGER) AS pos, {e} AS field FROM events'
    for i, e in enumerate(FIELD_EXPRS))


def _values(rows) -> str:
    body = ", ".join(f"('{t}', {int(p)}, CAST({int(c)} AS BIGINT))" for t, p, c in rows)
    return f'(SELECT * FROM (VALUES {body}) v(topic, "partition", cur))'


BOUNDS = (f'SELECT event_type AS topic, {E_PART} AS "partition", min({E_OFF}) AS earliest, '
          f'max({E_OFF}) + 1 AS latest FROM events GROUP BY 1, 2')
CLAMP = ("CASE WHEN c.cur < b.earliest THEN b.earliest WHEN c.cur > b.latest THEN b.latest "
         "ELSE c.cur END")
STATUS = "CASE WHEN c.cur < b.earliest THEN 'below' WHEN c.cur > b.latest THEN 'above' ELSE 'ok' END"

LIST_AGG_ORDER = f"ORDER BY {ELEM_ORDER}"


def _agg(expr: str) -> str:
    return f"COALESCE(string_agg({expr}, '|' {LIST_AGG_ORDER}), '')"


SHIP_TS = "strftime(l.l_shipdate, '%Y%m%d%H%M%S')"
SHIP_DAY = "strftime(l.l_shipdate, '%Y%m%d')"
LINE_FLAG = ("CASE WHEN l.l_orderkey IS NULL THEN NULL WHEN l.l_returnflag = 'A' THEN '0' "
             "WHEN l.l_returnflag = 'R' THEN '1' ELSE '9' END")

PROJECT_SIGNAL = (
    'SELECT o.o_orderkey AS "offset", '
    f"{IMSI} AS imsi, {O_TS} AS {_q('timestamp')}, "
    f"{_agg('CAST(l.l_partkey AS VARCHAR)')} AS region_code, "
    "o.o_orderstatus AS city_code, o.o_orderpriority AS county_code, "
    "CAST(o.o_custkey % 31 AS VARCHAR) AS usr_prov_code, CAST(o.o_custkey % 97 AS VARCHAR) AS usr_city_code, "
    "CAST(o.o_orderkey % 89 AS VARCHAR) AS usr_county_code, "
    "CASE WHEN o.o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex, "
    "CAST(o.o_custkey % 7 AS VARCHAR) AS age_level, CAST(o.o_orderkey % 5 AS VARCHAR) AS arpu_level, "
    "CAST(o.o_orderkey % 100 AS VARCHAR) AS out_city_code, CAST(o.o_orderkey % 1000 AS VARCHAR) AS out_county_code, "
    f"{_agg(SHIP_TS)} AS curr_region_intime, "
    f"{_agg(LINE_FLAG)} AS curr_region_in_out, "
    f"{_agg('CAST(l.l_suppkey AS VARCHAR)')} AS out_region, "
    f"{_agg(SHIP_DAY)} AS out_region_in_dt, "
    f"{_agg('CAST(l.l_linenumber AS VARCHAR)')} AS out_region_out_dt, "
    f"{_agg('l.l_linestatus')} AS out_region_stay "
    f"{WIDE_FROM} GROUP BY o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderstatus, o.o_orderpriority"
)

RANKED_LINES = (f"SELECT l.*, row_number() OVER (PARTITION BY l.l_orderkey ORDER BY {ELEM_ORDER}) AS rn, "
                "count(*) OVER (PARTITION BY l.l_orderkey) AS n FROM lineitem l")

PARALLEL_EXPLODE = (
    f'SELECT o.o_orderkey AS "offset", CAST(r.rn - 1 AS INTEGER) AS pos, '
    "CAST(r.l_partkey AS VARCHAR) AS region, strftime(r.l_shipdate, '%Y%m%d%H%M%S') AS in_time, "
    "strftime(r.l_shipdate, '%Y%m%d') AS in_dt "
    f"FROM orders o JOIN ({RANKED_LINES}) r ON r.l_orderkey = o.o_orderkey WHERE r.rn <= (r.n + 1) // 2 "
    "UNION ALL SELECT o.o_orderkey, CAST(0 AS INTEGER), '', '', '' FROM orders o "
    f"WHERE {NO_LINES}"
)

SPLIT_LIST_CELL = (
    'SELECT o.o_orderkey AS "offset", '
    "CAST(r.rn - 1 + CASE WHEN o.o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS pos, "
    "CAST(r.l_partkey AS VARCHAR) AS elem "
    f"FROM orders o JOIN ({RANKED_LINES}) r ON r.l_orderkey = o.o_orderkey "
    "UNION ALL SELECT o.o_orderkey, CAST(0 AS INTEGER), '' FROM orders o "
    f"WHERE o.o_orderkey % 5 = 0 AND {HAS_LINES} "
    "UNION ALL SELECT o.o_orderkey, CAST(0 AS INTEGER), '' FROM orders o "
    f"WHERE o.o_orderkey % 5 <> 0 AND o.o_orderkey % 3 = 0 AND {NO_LINES}"
)

EVENT_RECORDS = (f'SELECT event_type AS topic, {E_PART} AS "partition", {E_OFF} AS "offset", '
                 f'ts AS "timestamp", {E_RECKEY} AS key, {E_LINE} AS value, {E_BATCH} AS batch_id FROM events')

def _replay_sql(join: str, whole: str) -> str:
    return (f'SELECT e.topic, e."partition", e."offset", e.value FROM ({EVENT_RECORDS}) e '
            f'{join} {_values(COMMITTED_SUBSET)} c ON c.topic = e.topic AND c."partition" = e."partition" '
            f'WHERE {whole}e."offset" >= c.cur')


TAP = (f'SELECT {E_PART} AS "partition", {E_OFF} AS "offset", '
       f"'key:' || COALESCE({E_RECKEY}, 'null') || 'value:' || {E_LINE} AS line FROM events")

REGION_FANOUT = (_messages_sql(IN_COLS, SPLIT_CONF.topic_in) + " UNION ALL "
                 + _messages_sql(OUT_COLS, SPLIT_CONF.topic_out))

_topics = ", ".join(f"'{t}'" for t in topic_set(TOPIC_LIST))

ORACLE: dict[str, str] = {
    "region_in_rows": _rows_sql(IN_COLS),
    "region_in_messages": _messages_sql(IN_COLS, SPLIT_CONF.topic_in),
    "region_out_rows": _rows_sql(OUT_COLS),
    "region_out_messages": _messages_sql(OUT_COLS, SPLIT_CONF.topic_out),
    "region_fanout": REGION_FANOUT,
    "parallel_explode": PARALLEL_EXPLODE,
    "dedup_latest": DEDUP_LATEST,
    "dedup_latest_max_by": DEDUP_LATEST,
    "dedup_any": DEDUP_ANY,
    "dedup_messages": f"SELECT '{DEDUP_CONF.topic_out}' AS topic, key, value FROM ({DEDUP_LATEST}) d",
    "composite_key": f'SELECT {E_OFF} AS "offset", {E_KEY} AS key FROM events',
    "split_fields_csv": SPLIT_FIELDS,
    "split_fields_literal": SPLIT_FIELDS,
    "project_signal": PROJECT_SIGNAL,
    "split_list_cell": SPLIT_LIST_CELL,
    "clean_records": (f'SELECT {E_PART} AS "partition", {E_OFF} AS "offset", '
                      f"CASE WHEN event_id % 10 = 2 THEN ' ' ELSE {E_LINE} END AS value "
                      "FROM events WHERE event_id % 10 NOT IN (0, 1)"),
    "malformed_rows": (f'SELECT {E_PART} AS "partition", {E_OFF} AS "offset", '
                       "concat_ws('|', CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR), props) AS value, "
                       "CAST(3 AS INTEGER) AS n_fields FROM events WHERE event_id % 17 = 0"),
    "subscribe_topics": (f'SELECT event_type AS topic, {E_PART} AS "partition", {E_OFF} AS "offset", '
                         f"{E_LINE} AS value FROM events WHERE event_type IN ({_topics})"),
    "read_records": EVENT_RECORDS,
    "start_position": (f'SELECT b.topic, b."partition", COALESCE(c.cur, b.earliest) AS cur, '
                       "CASE WHEN c.cur IS NULL THEN 'earliest' ELSE 'committed' END AS source "
                       f'FROM ({BOUNDS}) b LEFT JOIN {_values(COMMITTED_SUBSET)} c '
                       'ON c.topic = b.topic AND c."partition" = b."partition"'),
    "offset_bounds": BOUNDS,
    "offset_resolve": (f'SELECT c.topic, c."partition", c.cur, b.earliest, b.latest, {CLAMP} AS start, '
                       f"{STATUS} AS status FROM {_values(STORED_POSITIONS)} c LEFT JOIN ({BOUNDS}) b "
                       'ON c.topic = b.topic AND c."partition" = b."partition"'),
    "replay_from_offsets": (f'SELECT e.topic, e."partition", e."offset", e.value FROM ({EVENT_RECORDS}) e '
                            f'JOIN {_values(STORED_POSITIONS)} c ON c.topic = e.topic AND c."partition" = e."partition" '
                            f'JOIN ({BOUNDS}) b ON b.topic = e.topic AND b."partition" = e."partition" '
                            f'WHERE e."offset" >= {CLAMP}'),
    "tap_records": TAP,
    "epoch_ms_to_text": ("SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, "
                         "strftime(ts, '%Y-%m-%d %H:%M:%S') AS text FROM events"),
    "text_to_epoch_ms": ("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS text, "
                         "epoch_ms(o_orderdate) AS epoch_ms FROM orders"),
    "epoch_ms_to_text_pattern": ("SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, "
                                 "strftime(ts, '%H:%M:%S') AS text FROM events"),
    "text_to_epoch_ms_pattern": ("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS text, "
                                 "epoch_ms(o_orderdate) AS epoch_ms FROM orders"),
    "stream_read_records": EVENT_RECORDS,
    "stream_region_fanout": REGION_FANOUT,
    "stream_dedup_latest": DEDUP_LATEST,
    "stream_tap": TAP,
    "batch_metrics": (f"SELECT batch_id, count(*) AS rows_in, count(DISTINCT key) AS rows_out, true AS timed "
                      f"FROM ({EVENTS_KEYED}) k GROUP BY batch_id"),
    "stream_dedup_any": DEDUP_ANY,
    "sink_messages": REGION_FANOUT,
    "replay_earliest": _replay_sql("LEFT JOIN", "c.cur IS NULL OR "),
    "replay_latest": _replay_sql("JOIN", ""),
    "dedup_latest_tied_topics": TIED_LATEST,
    "dedup_latest_max_by_tied_topics": TIED_LATEST,
    "dedup_any_tied_topics": TIED_ANY,
    "sink_resent": REGION_FANOUT,
    "fanout_order": (f'SELECT CAST(o.o_custkey % 8 AS INTEGER) AS "partition", {W_OFF} AS "offset", '
                     "greatest(count(l.l_orderkey), 1) AS n_current, greatest(count(l.l_orderkey), 1) AS n_left, "
                     f"true AS in_order {WIDE_FROM} GROUP BY 1, 2"),
    "replay_from_stored": (
        f"WITH e AS ({EVENT_RECORDS}), cur AS (SELECT topic, \"partition\", max(\"offset\") + 1 AS cur FROM e "
        "WHERE batch_id < (SELECT max(batch_id) FROM e) GROUP BY 1, 2) "
        'SELECT e.topic, e."partition", e."offset", e.value FROM e LEFT JOIN cur ON cur.topic = e.topic '
        'AND cur."partition" = e."partition" WHERE cur.cur IS NULL OR e."offset" >= cur.cur'),
    "footer_bounds": BOUNDS,
    "offset_gaps": (
        "SELECT 'dense' AS topic, p AS \"partition\", prev + 1 AS first_missing, o - 1 AS last_missing, o - prev - 1 AS missing FROM ("
        "SELECT CAST(event_id % 4 AS INTEGER) AS p, event_id // 4 AS o, "
        "lag(event_id // 4) OVER (PARTITION BY event_id % 4 ORDER BY event_id) AS prev FROM events "
        "WHERE event_id % 97 >= 3 AND event_id // 1000 % 13 <> 5) x WHERE o > prev + 1"),
    "decode_records": (f'SELECT topic, "partition", "offset", key, value FROM ({EVENT_RECORDS}) e '
                       'WHERE ("offset" - 100) % 19 <> 0 AND ("offset" - 100) % 23 <> 0'),
    "undecodable_records": (
        "SELECT topic, \"partition\", \"offset\", CASE WHEN n % 23 = 0 THEN 'FF' ELSE hex(encode(key)) END AS key_hex, "
        "hex(encode(value)) || CASE WHEN n % 19 = 0 THEN 'E282' ELSE '' END AS value_hex, "
        "CASE WHEN n % 19 = 0 AND n % 23 = 0 THEN 'key and value' WHEN n % 23 = 0 THEN 'key' ELSE 'value' END AS reason "
        f'FROM (SELECT *, "offset" - 100 AS n FROM ({EVENT_RECORDS}) e) x WHERE n % 19 = 0 OR n % 23 = 0'),
    "text_to_epoch_ms_null": (
        "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%Y-13-%d %H:%M:%S') "
        "ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS text, "
        "CASE WHEN o_orderkey % 7 <> 0 THEN epoch_ms(o_orderdate) END AS epoch_ms FROM orders"),
    "text_to_epoch_ms_lenient": (
        "SELECT k AS o_orderkey, concat(y, '-', m, '-', d, ' ', k % 50, ':', k % 90, ':', k % 100, "
        "CASE WHEN k % 3 = 0 THEN ' and more' ELSE '' END) AS text, "
        "epoch_ms(make_timestamp(y, 1, 1, 0, 0, 0) + to_months(CAST(m - 1 AS INTEGER)) + to_days(CAST(d - 1 AS INTEGER)) "
        "+ to_hours(k % 50) + to_minutes(k % 90) + to_seconds(k % 100)) AS epoch_ms "
        "FROM (SELECT o_orderkey AS k, year(o_orderdate) AS y, month(o_orderdate) + o_orderkey % 30 - 10 AS m, "
        "day(o_orderdate) + o_orderkey % 50 - 25 AS d FROM orders) x"),
}
