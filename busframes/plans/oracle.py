"""DuckDB oracle SQL for the registered queries (plain ``lineitem``
arithmetic; no code shared with the Spark encoders or decoders)."""

from __future__ import annotations

# frame columns from lineitem (µs ts), plus the payload bytes b0..b7
_F = """f AS (
  SELECT CAST(1 + l_suppkey % 2 AS SMALLINT) AS module,
         CAST((l_orderkey % 100000) * 1000000 + l_linenumber * 1000 AS BIGINT) AS ts,
         CAST(100 + l_linenumber AS INTEGER) AS id,
         l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk,
         CAST(l_linenumber AS BIGINT) AS ln, CAST(l_quantity AS BIGINT) AS qty,
         CAST(trunc(CAST(printf('%.6f', ((l_orderkey % 100000) * 1000000 + l_linenumber * 1000) / 1e6)
                         AS DOUBLE) * 1e9) AS BIGINT) AS ts_ns,
         printf('%02X %02X %02X %02X %02X %02X %02X %02X',
                l_orderkey & 255, (l_orderkey >> 8) & 255, l_partkey & 255, (l_partkey >> 8) & 255,
                l_suppkey & 255, (l_suppkey >> 8) & 255, CAST(l_quantity AS BIGINT) & 255,
                l_linenumber) AS hex
  FROM lineitem)"""

_ORDERKEY = "ok & 65535"
_PARTKEY = "pk & 65535"
_MID = "(((pk & 65535) | ((sk & 65535) << 16)) >> 4) & 1048575"
_FLAG = "(pk >> 15) & 1"
_QTY = "qty & 255"
_MSG = "id BETWEEN 101 AND 105"


def _sig(ts: str = "ts") -> str:
    """Decoded long form: one row per (frame, signal), info order positions."""
    parts = [
        f"SELECT {ts} AS ts, id, 'MSG_' || id AS botschaft, CAST({p} AS INTEGER) AS pos, "
        f"'{n}' AS signal_name, CAST({e} AS BIGINT) AS value FROM f WHERE {_MSG}"
        for p, n, e in [(0, "orderkey", _ORDERKEY), (1, "partkey", _PARTKEY), (2, "mid", _MID),
                        (3, "flag", _FLAG), (4, "qty", _QTY)]
    ]
    parts.append(f"SELECT {ts}, id, 'MSG_ALT', 0, 'orderkey', CAST({_ORDERKEY} AS BIGINT) FROM f WHERE id = 101")
    return "sig AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_TOTALS = """SELECT botschaft, signal_name, count(*) AS n, CAST(sum(value) AS BIGINT) AS total
FROM sig GROUP BY botschaft, signal_name"""

_LE = ("((ok & 255) | (((ok >> 8) & 255) << 8) | ((pk & 65535) << 16) | ((sk & 65535) << 32)"
       " | ((qty & 255) << 48) | (ln << 56))")

_VALS_TEXT = ("CAST(ok & 65535 AS VARCHAR) || ',' || CAST(pk & 65535 AS VARCHAR) || ',' || "
              f"CAST({_MID} AS VARCHAR) || ',' || CAST({_FLAG} AS VARCHAR) || ',' || CAST(qty & 255 AS VARCHAR)")


def _rows_text(ts: str, two: bool = False) -> str:
    more = f"""
  UNION ALL
  SELECT 'MSG_ALT', {ts}, id, '(' || CAST({ts} AS VARCHAR) || ',' || CAST(pk & 65535 AS VARCHAR) || ',' || CAST(qty & 255 AS VARCHAR) || ')'
  FROM f WHERE id = 106""" if two else ""
    return f"""r AS (
  SELECT 'MSG_' || id AS botschaft, {ts} AS ts, id,
         '(' || CAST({ts} AS VARCHAR) || ',' || {_VALS_TEXT} || ')' AS row_text FROM f WHERE {_MSG}
  UNION ALL
  SELECT 'MSG_ALT', {ts}, id, '(' || CAST({ts} AS VARCHAR) || ',' || CAST(ok & 65535 AS VARCHAR) || ')'
  FROM f WHERE id = 101{more}),
k AS (SELECT *, row_number() OVER (PARTITION BY botschaft ORDER BY ts, id, row_text) - 1 AS rk FROM r)"""


def _statements(ts: str, batch: int, head: str, two: bool = False) -> str:
    return _with(_F, _rows_text(ts, two)) + f"""SELECT botschaft, CAST(rk // {batch} AS BIGINT) AS batch,
  count(*) AS n_rows, {head} || ' VALUES ' || string_agg(row_text, ' ' ORDER BY rk) AS statement
FROM k GROUP BY botschaft, rk // {batch}"""


_FIELDS_SORTED = (f"'flag=' || CAST({_FLAG} AS VARCHAR) || 'i,mid=' || CAST({_MID} AS VARCHAR) || "
                  f"'i,orderkey=' || CAST(ok & 65535 AS VARCHAR) || 'i,partkey=' || CAST(pk & 65535 AS VARCHAR)"
                  f" || 'i,qty=' || CAST(qty & 255 AS VARCHAR) || 'i'")

_SQL_VIEW = _with(_F, _sig()) + """SELECT botschaft, signal_name, count(*) AS n,
  min(value) AS min_value, max(value) AS max_value FROM sig GROUP BY botschaft, signal_name"""

_CELLS = _with(_F, _sig("ts_ns")) + """SELECT botschaft || ':' || CAST(ts AS VARCHAR) AS row_key,
  'signals' AS family, signal_name AS qualifier, CAST(value AS VARCHAR) AS value FROM sig"""

_CS_U = "((l_orderkey * 2654435761 + l_partkey) % 4294967296 + 2147483648) % 4294967296"
_CS_FIELDS = [("EDL", 31, 1), ("BRS", 30, 1), ("ESI", 29, 1), ("unused_1", 28, 1), ("CODE", 24, 15),
              ("unused_2", 23, 1), ("SRR", 22, 1), ("IDE", 21, 1), ("RTR", 20, 1), ("DLC", 16, 15),
              ("TIMESTAMP", 0, 65535)]

_US = "(ts + 1601253345000000)"

_JOB_REPLAY = "WITH " + _F + ",\n" + f"""r0 AS (SELECT *, unnest(range(199, 210)) AS d FROM f WHERE id = 103),
r AS (SELECT 'MSG_' || id AS botschaft, ts + d * 86400000000 AS ts, id,
             '(' || CAST(ts + d * 86400000000 AS VARCHAR) || ',' || {_VALS_TEXT} || ')' AS row_text FROM r0),
k AS (SELECT *, row_number() OVER (PARTITION BY botschaft ORDER BY ts, id, row_text) - 1 AS rk FROM r)
SELECT botschaft, CAST(rk // 5000 AS BIGINT) AS batch, count(*) AS n_rows,
  'INSERT INTO Datalogger2_' || botschaft || ' USING ' || botschaft || ' TAGS (2,"Datalogger2") VALUES '
    || string_agg(row_text, ' ' ORDER BY rk) AS statement
FROM k GROUP BY botschaft, rk // 5000"""

ORACLE_SQL: dict[str, str] = {
    "decode_signal_totals": _with(_F, _sig()) + _TOTALS,
    "decode_long_rows": _with(_F, _sig()) + "SELECT ts, id, botschaft, pos, signal_name, value FROM sig",
    "decode_map_totals": _with(_F, _sig("ts_ns")) + _TOTALS,
    "decode_map_rows": _with(_F) + f"""SELECT ts_ns AS ts, id, 'MSG_' || id AS botschaft, 5 AS n_signals,
  replace({_FIELDS_SORTED}, 'i,', ',')[:-2] AS entries FROM f WHERE {_MSG}
UNION ALL SELECT ts_ns, id, 'MSG_ALT', 1, 'orderkey=' || CAST(ok & 65535 AS VARCHAR) FROM f WHERE id = 101""",
    "extract_bits_columns": _with(_F) + f"""SELECT ts, id,
  CAST({_FLAG} AS BIGINT) AS b_31_1, CAST(({_LE} >> 4) & 4095 AS BIGINT) AS b_4_12,
  CAST({_MID} AS BIGINT) AS b_20_20, CAST({_LE} AS BIGINT) AS b_0_64, CAST(NULL AS BIGINT) AS b_60_8 FROM f""",
    "text_trace_scan": _with(_F) + """SELECT module, ts_ns AS ts, id, 'Rx' AS dir,
  CAST(8 AS SMALLINT) AS len, hex AS data FROM f""",
    "text_trace_rejects": """SELECT CAST(NULL AS VARCHAR) AS reason, count(*) AS n FROM lineitem
UNION ALL SELECT 'too few tokens', CAST(1 AS BIGINT)""",
    "binary_trace_scan": _with(_F) + "SELECT module, ts, id, hex AS data_hex, 8 AS dlc FROM f",
    "binary_split_scan": _with(_F) + "SELECT module, ts, id, hex AS data_hex, 8 AS dlc FROM f",
    "binary_trace_rejects": """WITH k AS (SELECT l_orderkey // 1000 AS file_key, count(*) * 28 AS size
  FROM lineitem GROUP BY l_orderkey // 1000)
SELECT 'truncated record' AS reason, count(*) AS n, CAST(sum(size) AS BIGINT) AS sum_position
FROM k WHERE file_key % 3 = 0 HAVING count(*) > 0""",
    "binary_frame_blobs": _with(_F) + """SELECT id, count(*) AS n, CAST(sum(ts) AS BIGINT) AS sum_ts,
  CAST(sum((ok & 255) + ((ok >> 8) & 255) + (pk & 255) + ((pk >> 8) & 255) + (sk & 255) + ((sk >> 8) & 255)
           + (qty & 255) + ln) AS BIGINT) AS sum_bytes FROM f GROUP BY id""",
    "recordings_pushed_scan": _with(_F) + """SELECT module, ts, id, hex AS data_hex, 8 AS dlc FROM f
WHERE id IN (102, 105) AND module = 2 AND ts >= 2000000000""",
    "time_index_lookup": _with(_F) + """SELECT module, ts, id, hex AS data_hex, 8 AS dlc FROM f
WHERE id IN (101, 106) AND ts BETWEEN 2000000000 AND 30000000000""",
    "time_index_totals": _with(_F) + "SELECT count(*) AS n, min(ts) AS min_ts, max(ts) AS max_ts FROM f",
    "decode_trace_function": _with(_F, _sig().replace("SELECT ts AS ts,", "SELECT module, ts AS ts,").replace("SELECT ts, id,", "SELECT module, ts, id,")) + """
SELECT botschaft, signal_name, module, count(*) AS n, CAST(sum(value) AS BIGINT) AS total
FROM sig WHERE id = 101 AND ts >= 2000000000 GROUP BY ALL""",
    "binary_raw_fetch": """SELECT printf('part-%06d.bin', l_orderkey // 1000) AS file_name,
  CAST(count(*) * 28 AS BIGINT) AS length FROM lineitem GROUP BY l_orderkey // 1000""",
    "control_word_fields": "SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, " + ", ".join(
        f"CAST(({_CS_U} >> {s}) & {m} AS INTEGER) AS {n}" for n, s, m in _CS_FIELDS) + " FROM lineitem",
    "replay_one_message": _with(_F, _sig()) + """SELECT botschaft, signal_name, 11 * count(*) AS n,
  CAST(11 * sum(value) AS BIGINT) AS total, min(ts) + 199 * 86400000000 AS min_ts,
  max(ts) + 209 * 86400000000 AS max_ts FROM sig WHERE id = 103 GROUP BY botschaft, signal_name""",
    "replay_decode_totals": _with(_F, _sig()) + """SELECT botschaft, signal_name, 11 * count(*) AS n,
  CAST(11 * sum(value) AS BIGINT) AS total, min(ts) + 199 * 86400000000 AS min_ts,
  max(ts) + 209 * 86400000000 AS max_ts FROM sig GROUP BY botschaft, signal_name""",
    "job_replayed_statements": _JOB_REPLAY,
    "job_text_message_tables": _with(_F) + f"""SELECT 'MSG_' || id AS botschaft, ts_ns AS ts, id,
  {_VALS_TEXT} AS values_text FROM f WHERE {_MSG}
UNION ALL SELECT 'MSG_ALT', ts_ns, id, CAST(ok & 65535 AS VARCHAR) FROM f WHERE id = 101
UNION ALL SELECT 'MSG_ALT', ts_ns, id, CAST(pk & 65535 AS VARCHAR) || ',' || CAST(qty & 255 AS VARCHAR) FROM f WHERE id = 106""",
    "frame_time_strings": _with(_F) + f"""SELECT id, {_US} AS ts,
  strftime(make_timestamp({_US}), '%Y-%m-%d %H:%M:%S.%f') AS ts_text,
  strftime(make_timestamp(({_US} // 1000) * 1000), '%Y-%m-%d %H:%M:%S.%g') AS ts_ms_text,
  strftime(make_timestamp({_US}), '%Y%m%d%H') AS hour,
  epoch_ms(date_trunc('hour', make_timestamp({_US}))) AS hour_ms FROM f""",
    "module_raw_rows": _with(_F) + """SELECT module,
  strftime(make_timestamp(ts_ns // 1000), '%Y-%m-%d %H:%M:%S.%f') AS ts, id,
  CAST(8 AS SMALLINT) AS len, hex AS data FROM f""",
    "distinct_modules": _with(_F) + "SELECT DISTINCT module FROM f",
    "distinct_ids": _with(_F) + "SELECT DISTINCT id FROM f",
    "frame_count": "SELECT count(*) AS n_rows FROM lineitem",
    "module_null_safe": _with(_F) + "SELECT id, count(*) AS n FROM f WHERE module IS NOT DISTINCT FROM 2 GROUP BY id",
    "id_equals_literal": _with(_F) + """SELECT module, count(*) AS n, CAST(sum(ts) AS BIGINT) AS sum_ts
FROM f WHERE id = 103 GROUP BY module""",
    "ts_point_lookup": _with(_F) + "SELECT module, ts, id, hex AS data_hex FROM f WHERE ts = 1003000",
    "first_frames_preview": _with(_F) + """SELECT ts, id, module, hex AS data_hex FROM f
ORDER BY ts, id, module, data_hex LIMIT 100""",
    "message_names_per_id": _with(_F) + f"SELECT id, 'MSG_' || id AS botschaft, count(*) AS n FROM f WHERE {_MSG} GROUP BY id",
    "signal_lists": _with(_F) + f"""SELECT 'MSG_' || id AS botschaft, count(*) AS n,
  'orderkey,partkey,mid,flag,qty' AS signal_names FROM f WHERE {_MSG} GROUP BY id
UNION ALL SELECT 'MSG_ALT', count(*), 'orderkey' FROM f WHERE id = 101""",
    "wide_message_rows": _with(_F) + f"""SELECT ts_ns AS ts, id, 'MSG_' || id AS botschaft,
  CAST({_FLAG} AS BIGINT) AS flag, CAST({_MID} AS BIGINT) AS mid, CAST(ok & 65535 AS BIGINT) AS orderkey,
  CAST(pk & 65535 AS BIGINT) AS partkey, CAST(qty & 255 AS BIGINT) AS qty FROM f WHERE {_MSG}
UNION ALL SELECT ts_ns, id, 'MSG_ALT', NULL, NULL, CAST(ok & 65535 AS BIGINT), NULL, NULL FROM f WHERE id = 101""",
    "ordered_map_values": _with(_F) + f"""SELECT ts_ns AS ts, id, 'MSG_' || id AS botschaft,
  {_VALS_TEXT} AS values_text FROM f WHERE {_MSG}
UNION ALL SELECT ts_ns, id, 'MSG_ALT', CAST(ok & 65535 AS VARCHAR) FROM f WHERE id = 101
UNION ALL SELECT ts_ns, id, 'MSG_ALT', CAST(pk & 65535 AS VARCHAR) || ',' || CAST(qty & 255 AS VARCHAR) FROM f WHERE id = 106""",
    "insert_statements_batched": _statements(
        "ts", 5000, "'INSERT INTO Datalogger1_' || botschaft || ' USING ' || botschaft || ' TAGS (2,\"Datalogger1\")'"),
    "insert_statements_grouped": _statements(
        "ts_ns", 20000, "'INSERT INTO ' || botschaft || '_1_2 USING ' || botschaft || ' TAGS (2,\"Datalogger1\")'", two=True),
    "line_protocol_points": _with(_F) + f"""SELECT 'MSG_' || id AS measurement, ts AS time,
  'MSG_' || id || ',device=Datalogger1 ' || {_FIELDS_SORTED} || ' ' || CAST(ts AS VARCHAR) AS line
FROM f WHERE {_MSG}
UNION ALL SELECT 'MSG_ALT', ts, 'MSG_ALT,device=Datalogger1 orderkey=' || CAST(ok & 65535 AS VARCHAR)
  || 'i ' || CAST(ts AS VARCHAR) FROM f WHERE id = 101""",
    "hour_stamped_points": _with(_F) + f"""SELECT 'MSG_' || id AS measurement,
  epoch_ms(date_trunc('hour', make_timestamp({_US}))) AS time_ms,
  'MSG_' || id || ',device=Datalogger1 ' || {_FIELDS_SORTED} || ' '
    || CAST(epoch_ms(date_trunc('hour', make_timestamp({_US}))) AS VARCHAR) AS line
FROM f WHERE {_MSG}
UNION ALL SELECT 'MSG_ALT', epoch_ms(date_trunc('hour', make_timestamp({_US}))),
  'MSG_ALT,device=Datalogger1 orderkey=' || CAST(ok & 65535 AS VARCHAR) || 'i '
    || CAST(epoch_ms(date_trunc('hour', make_timestamp({_US}))) AS VARCHAR) FROM f WHERE id = 101""",
    "wide_store_rows": _with(_F, _sig()) + """SELECT botschaft AS table_name, 'Datalogger1' AS deviceid,
  ts // 1000 AS ts_ms, signal_name AS column_name, CAST(value AS DECIMAL(20,0)) AS value FROM sig""",
    "key_value_cells": _CELLS,
    "wide_cells": _CELLS,
    "csv_message_files": _with(_F, _sig()) + "SELECT botschaft, ts, id, signal_name, value FROM sig",
    "sql_over_views": _SQL_VIEW,
    "query_rows_as_maps": "WITH s AS (" + _SQL_VIEW + """)
SELECT botschaft, signal_name, 'n' AS column_name, CAST(n AS VARCHAR) AS value FROM s
UNION ALL SELECT botschaft, signal_name, 'min_value', CAST(min_value AS VARCHAR) FROM s
UNION ALL SELECT botschaft, signal_name, 'max_value', CAST(max_value AS VARCHAR) FROM s""",
    "dictionary_from_file": _with(_F) + f"""SELECT 'MSG_' || id AS botschaft, count(*) AS n,
  CAST(5 * count(*) AS BIGINT) AS n_values FROM f WHERE {_MSG} GROUP BY id
UNION ALL SELECT 'MSG_ALT', count(*), CAST(count(*) AS BIGINT) FROM f WHERE id = 101""",
    "job_binary_message_tables": _with(_F) + f"""SELECT 'MSG_' || id AS target, ts // 1000 AS ts_ms, id,
  'orderkey=' || (ok & 65535) || ',partkey=' || (pk & 65535) || ',mid=' || ({_MID}) || ',flag=' || ({_FLAG}) || ',qty=' || (qty & 255) AS values_text
FROM f WHERE {_MSG}
UNION ALL SELECT 'MSG_ALT_101', ts // 1000, id, 'orderkey=' || (ok & 65535) FROM f WHERE id = 101
UNION ALL SELECT 'MSG_ALT_106', ts // 1000, id, 'partkey=' || (pk & 65535) || ',qty=' || (qty & 255) FROM f WHERE id = 106""",
    "job_wide_store_rows": _with(_F) + f"""SELECT 'MSG_' || id AS table_name, 'Datalogger1' AS deviceid,
  strftime(make_timestamp((ts // 1000) * 1000), '%Y-%m-%d %H:%M:%S') AS ts_text, 'orderkey,partkey,mid,flag,qty' AS names, {_VALS_TEXT} AS values_text
FROM f WHERE {_MSG}
UNION ALL SELECT 'MSG_ALT', 'Datalogger1', strftime(make_timestamp((ts // 1000) * 1000), '%Y-%m-%d %H:%M:%S'), 'orderkey', CAST(ok & 65535 AS VARCHAR)
FROM f WHERE id = 101""",
    "job_module_tables": _with(_F) + """SELECT 'datalogger_1_can' || module AS target,
  strftime(make_timestamp(ts_ns // 1000), '%Y-%m-%d %H:%M:%S.%f') AS ts, id, CAST(8 AS SMALLINT) AS len, hex AS data FROM f""",
    "job_preview": _with(_F) + f"""SELECT * FROM (SELECT ts_ns AS ts, id, 'MSG_' || id AS botschaft FROM f WHERE {_MSG}
UNION ALL SELECT ts_ns, id, 'MSG_ALT' FROM f WHERE id = 101) ORDER BY ts, id, botschaft LIMIT 100""",
    "message_views": _with(_F) + f"""SELECT 'msg_' || CASE WHEN botschaft = 'MSG_ALT' THEN 'MSG_ALT_' || identifier ELSE botschaft END AS view_name,
  botschaft, identifier, signal_name, count(*) AS n, CAST(sum(value) AS BIGINT) AS total FROM (
  SELECT 'MSG_' || id AS botschaft, id AS identifier, 'orderkey' AS signal_name, ok & 65535 AS value FROM f WHERE {_MSG}
  UNION ALL SELECT 'MSG_' || id, id, 'partkey', pk & 65535 FROM f WHERE {_MSG}
  UNION ALL SELECT 'MSG_' || id, id, 'mid', {_MID} FROM f WHERE {_MSG}
  UNION ALL SELECT 'MSG_' || id, id, 'flag', {_FLAG} FROM f WHERE {_MSG}
  UNION ALL SELECT 'MSG_' || id, id, 'qty', qty & 255 FROM f WHERE {_MSG}
  UNION ALL SELECT 'MSG_ALT', id, 'orderkey', ok & 65535 FROM f WHERE id = 101
  UNION ALL SELECT 'MSG_ALT', id, 'partkey', pk & 65535 FROM f WHERE id = 106
  UNION ALL SELECT 'MSG_ALT', id, 'qty', qty & 255 FROM f WHERE id = 106) GROUP BY ALL""",
    "text_fd_frames": _with(_F) + """SELECT ts_ns AS ts, id, CAST(n AS SMALLINT) AS len, substr(repeat(hex || ' ', 8), 1, 3 * n - 1) AS data,
  CAST(pk & 65535 AS BIGINT) AS late, CAST(ln | ((ok & 255) << 8) AS BIGINT) AS cross
FROM (SELECT *, list_extract([12, 16, 20, 24, 32, 48, 64], CAST(ln AS INTEGER)) AS n FROM f)""",
    "text_malformed_rejects": """SELECT CASE l_linenumber WHEN 4 THEN 'bad id' WHEN 5 THEN 'frame' WHEN 6 THEN 'bad seconds'
  WHEN 7 THEN 'too few tokens' ELSE 'payload differs from byte count' END AS reason,
  CAST(CASE WHEN l_linenumber = 4 THEN NULL ELSE 100 + l_linenumber END AS INTEGER) AS id, count(*) AS n FROM lineitem GROUP BY l_linenumber""",
    "line_protocol_escapes": r"""SELECT 'A B,c=d' AS measurement, ts AS time, 'A\ B\,c\=d,device=dev\ 1 ' || concat_ws(',',
    CASE WHEN ln % 2 = 1 THEN 'f\ x=' || pk || 'i' END, CASE WHEN ln % 3 = 0 THEN 'g\,y=7i' END) || ' ' || ts AS line
  FROM (SELECT CAST((l_orderkey % 100000) * 1000000 + l_linenumber AS BIGINT) AS ts, l_linenumber AS ln, l_partkey AS pk FROM lineitem)
  WHERE ln % 2 = 1 OR ln % 3 = 0""",
    "global_order": _with(_F) + "SELECT id, count(*) AS n, CAST(0 AS BIGINT) AS out_of_order FROM f GROUP BY id",
    "recordings_in_time_order": _with(_F) + """SELECT row_number() OVER (ORDER BY ts, id, module, hex) AS place,
  module, ts, id, hex AS data_hex, 8 AS dlc FROM f""",
    "region_cells": _with(_F, _sig("ts_ns")) + """SELECT CAST(CASE WHEN k >= 'MSG_105:' THEN 3 WHEN k >= 'MSG_103:5' THEN 2 WHEN k >= 'MSG_102:' THEN 1 ELSE 0 END AS INTEGER) AS region,
  count(*) AS n, min(k) AS first_key, max(k) AS last_key, CAST(sum(value) AS BIGINT) AS total
FROM (SELECT botschaft || ':' || CAST(ts AS VARCHAR) AS k, value FROM sig) GROUP BY 1""",
    "bucketed_totals": _with(_F) + """SELECT id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts,
  CASE WHEN id = 101 THEN 'MSG_101' WHEN id BETWEEN 102 AND 105 THEN 'MSG_' || id END AS botschaft,
  CASE WHEN id BETWEEN 101 AND 105 THEN CAST(sum(module) AS BIGINT) END AS sum_module FROM f GROUP BY id""",
    "dictionary_order": _with(_F) + """SELECT CAST(place AS INTEGER) AS place, CAST(d.id AS INTEGER) AS identifier, botschaft, signals, (SELECT count(*) FROM f WHERE f.id = d.id) AS n
FROM (VALUES (1, 101, 'MSG_101', 'orderkey,partkey,mid,flag,qty'), (2, 101, 'MSG_ALT', 'orderkey'), (3, 102, 'MSG_102', 'orderkey,partkey,mid,flag,qty'),
  (4, 103, 'MSG_103', 'orderkey,partkey,mid,flag,qty'), (5, 104, 'MSG_104', 'orderkey,partkey,mid,flag,qty'),
  (6, 105, 'MSG_105', 'orderkey,partkey,mid,flag,qty')) AS d(place, id, botschaft, signals)""",
    "committed_delivery": _with(_F) + """SELECT id, module, count(*) AS n, CAST(sum(ts) AS BIGINT) AS sum_ts,
  (SELECT count(*) FROM f) AS sent FROM f GROUP BY id, module""",
    "delivered_batches": _with(_F) + """SELECT id, count(*) AS n, CAST(sum(ts) AS BIGINT) AS sum_ts, 1 AS today,
  (SELECT count(*) FROM f) AS sent FROM f GROUP BY id""",
}
ORACLE_SQL["job_points"] = ORACLE_SQL["line_protocol_points"]
ORACLE_SQL["job_grouped_statements"] = _statements(
    "ts", 20000, "'INSERT INTO ' || botschaft || '_1_2 USING ' || botschaft || ' TAGS (2,\"Datalogger1\")'")
