"""The registered queries as SQL over the same tables, for checking results in another engine."""

from __future__ import annotations

CELLS = """
SELECT {key} AS row_key, 'info' AS family, 'name' AS qualifier, c_name AS value FROM customer
UNION ALL SELECT {key}, 'info', 'segment', c_mktsegment FROM customer
UNION ALL SELECT {key}, 'geo', 'nation', CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT {key}, 'acct', 'tier', CASE WHEN c_acctbal >= 7000 THEN 'gold' ELSE 'silver' END
FROM customer WHERE c_acctbal >= 3000
"""
ID = "CAST(c_custkey AS VARCHAR)"
PADDED = f"lpad({ID}, 19, '0')"
CC = f"WITH cc AS ({CELLS.format(key=PADDED)}) "
SC = f"WITH sc AS ({CELLS.format(key=f'left(md5({ID}), 3) || {ID}')}) "

GOLD = "row_key IN (SELECT row_key FROM cc WHERE family = 'acct' AND qualifier = 'tier' AND value = 'gold')"
NOT_GOLD = GOLD.replace("value = 'gold'", "value <> 'gold'").replace("row_key IN", "row_key NOT IN")

NO_NAME = f"""(family = 'info' AND qualifier = 'name' AND row_key IN
  (SELECT {PADDED} FROM customer WHERE c_mktsegment = 'MACHINERY'))"""

LOG = """
WITH el AS (
  SELECT lpad(CAST(user_id AS VARCHAR), 19, '0') AS row_key,
    CASE WHEN event_type = 'purchase' THEN 'buy' WHEN event_type = 'error' AND value >= 40 THEN NULL ELSE 'ev'
    END AS family,
    CASE event_type WHEN 'purchase' THEN 'last' WHEN 'signup' THEN 'view' WHEN 'click' THEN 'click'
      WHEN 'view' THEN 'view' END AS qualifier,
    epoch_us(ts) AS ts, event_id AS seq,
    CASE WHEN event_type IN ('click', 'view', 'purchase') THEN props END AS value,
    CASE WHEN event_type = 'signup' THEN 'delete_column'
      WHEN event_type = 'error' AND value >= 40 THEN 'delete_row'
      WHEN event_type = 'error' THEN 'delete_family' ELSE 'put' END AS op,
    CAST(epoch_us(ts) AS HUGEINT) * 1000000000000 + event_id AS version
  FROM events),
marked AS (
  SELECT *,
    max(CASE WHEN op = 'delete_row' THEN version END) OVER (PARTITION BY row_key) AS row_marker,
    max(CASE WHEN op = 'delete_family' THEN version END) OVER (PARTITION BY row_key, family) AS family_marker,
    max(CASE WHEN op = 'delete_column' THEN version END)
      OVER (PARTITION BY row_key, family, qualifier) AS column_marker
  FROM el),
visible AS (
  SELECT row_key, family, qualifier, ts, seq, value FROM marked
  WHERE op = 'put' AND version >= greatest(coalesce(row_marker, 0), coalesce(family_marker, 0),
                                           coalesce(column_marker, 0))
  QUALIFY row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY version DESC) = 1)
"""

LINES = """
WITH lines AS (
  SELECT lpad(CAST(user_id AS VARCHAR), 19, '0') AS key, event_type AS name, CAST(event_id AS VARCHAR) AS age,
    event_type, epoch_us(ts) AS ts, event_id FROM events)
"""


def _delimited(good: str, reason: str) -> str:
    return f"""{LINES}
SELECT CASE WHEN {good} THEN key END AS key, CASE WHEN {good} THEN name END AS name,
  CASE WHEN {good} THEN age END AS age,
  CASE WHEN {good} THEN NULL WHEN event_type = 'error' THEN key || ',' || name
    WHEN event_type = 'view' THEN key || ',' || name || ','
    ELSE key || ',' || name || ',' || age || ',more' END AS line,
  CASE WHEN {good} THEN NULL ELSE {reason} END AS reject
FROM lines"""


def _deleted(hidden: str) -> str:
    return f"""{CC} SELECT * FROM cc WHERE NOT ({hidden} AND row_key IN
  (SELECT {PADDED} FROM customer WHERE c_mktsegment = 'MACHINERY'))"""


OPERATORS = {
    "less": "<", "less_or_equal": "<=", "equal": "=", "not_equal": "<>", "greater_or_equal": ">=", "greater": ">",
}
COMPARED = ", ".join(
    [f"value {sign} '9' AS raw_{name}" for name, sign in OPERATORS.items()]
    + ["false AS raw_no_op"]
    + [f"CAST(value AS INTEGER) {sign} 9 AS typed_{name}" for name, sign in OPERATORS.items()]
    + ["false AS typed_no_op"]
)


def _hex(number: str, digits: int) -> str:
    """The low hex digits of a number in two's complement."""
    return f"right(lpad(printf('%X', CAST({number} AS BIGINT)), 16, '0'), {digits})"


MILLIS = "(epoch_us(ts) // 1000)"
JOINED = "string_agg(value, '{sep}' ORDER BY family, qualifier)"
DIGESTED = " || ',' || ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in ("t", "u", "k", "r", "url"))
WORDS = """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
WHERE word <> '' GROUP BY word"""

ORACLES: dict[str, str] = {
    "scan_full": f"{CC} SELECT * FROM cc",
    "scan_range": f"{SC} SELECT * FROM sc WHERE row_key >= '4' AND row_key < 'c'",
    "get_row": f"{CC} SELECT * FROM cc WHERE row_key = lpad('42', 19, '0')",
    "get_rows": f"""{CC} SELECT * FROM cc WHERE NOT {NO_NAME} AND row_key IN
      (SELECT lpad(CAST(o_custkey AS VARCHAR), 19, '0') FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "scan_family": f"{CC} SELECT * FROM cc WHERE family = 'info'",
    "scan_column": f"{CC} SELECT * FROM cc WHERE family = 'info' AND qualifier = 'name'",
    "scan_log_columns": f"""{LOG} SELECT row_key, family, qualifier, value FROM visible
      WHERE family = 'buy' OR (family = 'ev' AND qualifier = 'view')""",
    "key_range_stats": f"""{SC}, ranges(range_start, range_stop) AS
      (VALUES ('2', '4'), ('4', '8'), ('8', 'c'), ('c', 'e')),
      per_row AS (SELECT row_key, count(*) AS n FROM sc GROUP BY row_key)
      SELECT range_start, range_stop, count(row_key) AS n_rows, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_cells,
        coalesce(max(n), 0) AS longest_row
      FROM ranges LEFT JOIN per_row ON row_key >= range_start AND row_key < range_stop
      GROUP BY range_start, range_stop""",
    "key_range_stats_log": f"""{LOG}, ranges(range_start, range_stop) AS (VALUES (lpad('5', 19, '0'), lpad('100', 19, '0')),
        (lpad('100', 19, '0'), lpad('400', 19, '0')), (lpad('400', 19, '0'), '')),
      per_row AS (SELECT row_key, count(*) AS n FROM visible GROUP BY row_key)
      SELECT range_start, range_stop, count(row_key) AS n_rows, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_cells,
        coalesce(max(n), 0) AS longest_row
      FROM ranges LEFT JOIN per_row ON row_key >= range_start AND (range_stop = '' OR row_key < range_stop)
      GROUP BY range_start, range_stop""",
    "read_wide": f"""SELECT {PADDED} AS row_key, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation,
      CASE WHEN c_acctbal >= 7000 THEN 'gold' WHEN c_acctbal >= 3000 THEN 'silver' END AS tier FROM customer""",
    "read_wide_bytes": f"""SELECT {PADDED} AS row_key, c_name AS name, CAST(c_custkey - 750 AS INTEGER) AS number,
      (c_custkey - 750) * 3000000019 AS large FROM customer""",
    "filter_bytes_typed": f"""SELECT {PADDED} AS row_key, 'name' AS qualifier, hex(encode(c_name)) AS value_hex
      FROM customer WHERE c_custkey < 750
      UNION ALL SELECT {PADDED}, 'number', {_hex('c_custkey - 750', 8)} FROM customer WHERE c_custkey < 750""",
    "wide_to_cells": """WITH o AS (SELECT *, lpad(CAST(o_orderkey AS VARCHAR), 19, '0') AS row_key FROM orders)
      SELECT row_key, 'o' AS family, 'status' AS qualifier, o_orderstatus AS value FROM o
      UNION ALL SELECT row_key, 'o', 'priority', o_orderpriority FROM o
      UNION ALL SELECT row_key, 'o', 'customer', CAST(o_custkey AS VARCHAR) FROM o
      UNION ALL SELECT row_key, 'o', 'open', 'yes' FROM o WHERE o_orderstatus <> 'F'""",
    "render_cells": f"""{CC} SELECT row_key, concat_ws('::', family, qualifier, value) AS scanned,
      concat_ws('::', qualifier, value) AS got FROM cc""",
    "scan_joined": f"{CC} SELECT row_key, {JOINED.format(sep='_')} AS value FROM cc GROUP BY row_key",
    "filter_joined_prefix": f"""{CC} SELECT * FROM (SELECT row_key, {JOINED.format(sep='-')} AS value FROM cc
      WHERE family IN ('acct', 'info') GROUP BY row_key) WHERE starts_with(value, 'gold-')""",
    "codec_roundtrip": f"""SELECT c_custkey, {_hex('c_custkey - 750', 8)} AS int_hex,
      CAST(c_custkey - 750 AS INTEGER) AS int_back,
      {_hex('(c_custkey - 750) * 3000000019', 16)} AS bigint_hex,
      (c_custkey - 750) * 3000000019 AS bigint_back,
      hex(encode(c_name)) AS text_hex, c_name AS text_back FROM customer""",
    "key_reverse": "SELECT o_orderkey, reverse(CAST(o_orderkey AS VARCHAR)) AS row_key FROM orders",
    "key_salt": """SELECT o_orderkey, left(md5(CAST(o_orderkey AS VARCHAR)), 3) || CAST(o_orderkey AS VARCHAR)
      AS row_key, CAST(o_orderkey AS VARCHAR) AS unsalted FROM orders""",
    "key_time": f"""SELECT event_id, {_hex(MILLIS, 16)} || {_hex('event_id', 16)} AS key_hex,
      '1' || lpad(CAST({MILLIS} AS VARCHAR), 19, '0') || '-1' || lpad(CAST(event_id AS VARCHAR), 19, '0') AS key_text
      FROM events""",
    "key_composite": f"""SELECT event_id, {_hex('user_id % 16', 2)} || {_hex('user_id', 16)} ||
      {_hex(f"{MILLIS} // 1000", 8)} || {_hex('event_id', 16)} AS key_hex FROM events""",
    "filter_key_prefix": f"{SC} SELECT * FROM sc WHERE starts_with(row_key, 'a')",
    "filter_key_regex": f"{CC} SELECT * FROM cc WHERE regexp_matches(row_key, '7$')",
    "filter_key_literal": f"{SC} SELECT * FROM sc WHERE starts_with(row_key, 'b')",
    "filter_key_compare": f"{SC} SELECT * FROM sc WHERE row_key >= '5' AND row_key < '9'",
    "filter_column_prefix": f"{CC} SELECT * FROM cc WHERE starts_with(qualifier, 'na')",
    "filter_column_value": f"{CC} SELECT * FROM cc WHERE {NOT_GOLD}",
    "filter_column_value_strict": f"{CC} SELECT * FROM cc WHERE {GOLD}",
    "filter_any": f"{CC} SELECT * FROM cc WHERE {GOLD} OR regexp_matches(row_key, '7$')",
    "filter_all": f"{CC} SELECT * FROM cc WHERE {GOLD} AND starts_with(qualifier, 'na')",
    "filter_nested": f"""{CC} SELECT * FROM cc WHERE family = 'info' AND qualifier = 'name'
      AND regexp_matches(row_key, '[02468]$') AND ({GOLD} OR row_key IN (SELECT row_key FROM cc
        WHERE family = 'geo' AND qualifier = 'nation' AND CAST(value AS INTEGER) < 10))""",
    "filter_compare_ops": f"{CC} SELECT row_key, value, {COMPARED} FROM cc WHERE family = 'geo'",
    "resolve_latest": f"{LOG} SELECT * FROM visible",
    "resolve_versions": """SELECT lpad(CAST(l_orderkey AS VARCHAR), 19, '0') AS row_key, 'line' AS family,
      CAST(l_linenumber AS VARCHAR) AS qualifier, epoch_us(l_shipdate) AS ts, l_partkey AS seq,
      l_returnflag || l_linestatus AS value FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_returnflag || l_linestatus DESC) = 1""",
    "put_batch": f"{LOG} SELECT row_key, family, qualifier, value FROM visible",
    "put_update": f"""{CC} SELECT row_key, family, qualifier, CASE WHEN qualifier = 'segment' AND row_key IN
      (SELECT {PADDED} FROM customer WHERE c_acctbal >= 9000) THEN 'VIP' ELSE value END AS value FROM cc""",
    "delete_row": _deleted("true"),
    "delete_family": _deleted("family = 'info'"),
    "delete_column": _deleted("family = 'info' AND qualifier = 'name'"),
    "delete_columns": _deleted("family = 'info' AND qualifier IN ('name', 'segment')"),
    "delete_newest": f"""{LOG}, versions AS (
        SELECT *, sum(CASE WHEN op = 'put' THEN 1 ELSE -1 END)
          OVER (PARTITION BY row_key, family, qualifier ORDER BY version DESC) AS outnumbers
        FROM marked WHERE op IN ('put', 'delete_column'))
      SELECT row_key, family, qualifier, ts, seq, value FROM (
        SELECT * FROM versions WHERE op = 'put' AND outnumbers >= 1
        QUALIFY row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY version DESC) = 1)
      WHERE version >= greatest(coalesce(row_marker, 0), coalesce(family_marker, 0))""",
    "bulk_load_aligned": f"{SC} SELECT * FROM sc WHERE row_key >= '4' AND row_key < 'c'",
    "get_rows_aligned": f"""{SC} SELECT * FROM sc WHERE row_key IN (SELECT left(md5(CAST(o_custkey AS VARCHAR)), 3) ||
      CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "table_lifecycle": f"{CC} SELECT * FROM cc WHERE family = 'info'",
    "table_compaction": f"{LOG} SELECT row_key, family, qualifier, value FROM visible",
    "sql_upsert": """SELECT c_custkey, c_name, CASE WHEN c_acctbal < -500 THEN 'STOP'
      WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
    "sql_upsert_files": """SELECT c_custkey, c_name, CASE WHEN c_acctbal < -500 THEN 'STOP'
      WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
    "word_count": WORDS,
    "word_count_cells": f"""SELECT word AS row_key, 'content' AS family, 'info' AS qualifier,
      CAST(n AS VARCHAR) AS value FROM ({WORDS})""",
    "csv_source": _delimited("event_type NOT IN ('error', 'view')", "'too few fields'"),
    "csv_source_strict": _delimited(
        "event_type NOT IN ('error', 'view', 'signup')",
        "CASE event_type WHEN 'signup' THEN 'too many fields' ELSE 'too few fields' END",
    ),
    "log_bulk_load": f"""WITH records AS (SELECT CAST(epoch_us(ts) AS VARCHAR) AS t, CAST(user_id AS VARCHAR) AS u,
        event_type AS k, CAST(event_id AS VARCHAR) AS r, props AS url FROM events),
      keyed AS (SELECT *, sha256({DIGESTED}) || '-' || lpad(CAST(
        row_number() OVER (PARTITION BY t, u, k, r, url) AS VARCHAR), 19, '0') AS row_key FROM records)
      SELECT row_key, 'cf1' AS family, 'time' AS qualifier, t AS value FROM keyed
      UNION ALL SELECT row_key, 'cf1', 'userId', u FROM keyed
      UNION ALL SELECT row_key, 'cf1', 'keyWord', k FROM keyed
      UNION ALL SELECT row_key, 'cf1', 'ranking', r FROM keyed
      UNION ALL SELECT row_key, 'cf1', 'url', url FROM keyed""",
    "bulk_load_single": f"""SELECT left(md5({ID}), 3) || {ID} AS row_key, 'cf1' AS family, 'name' AS qualifier,
      c_name AS value FROM customer""",
    "bulk_load_multi": """WITH o AS (SELECT *, left(md5(CAST(o_orderkey AS VARCHAR)), 3) ||
        CAST(o_orderkey AS VARCHAR) AS row_key FROM orders)
      SELECT row_key, 'cf1' AS family, 'status' AS qualifier, o_orderstatus AS value FROM o
      UNION ALL SELECT row_key, 'cf1', 'priority', o_orderpriority FROM o""",
    "upsert_write": f"""WITH c AS (SELECT *, reverse({PADDED}) AS row_key FROM customer)
      SELECT row_key, 'cf1' AS family, 'name' AS qualifier, c_name AS value FROM c
      UNION ALL SELECT row_key, 'cf1', 'segment', CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END
      FROM c""",
    "connector_roundtrip": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "stream_upsert": f"""{LINES}, kept AS (SELECT * FROM lines WHERE event_type NOT IN ('error', 'view')
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) = 1)
      SELECT key AS row_key, 'cf1' AS family, 'name' AS qualifier, name AS value FROM kept
      UNION ALL SELECT key, 'cf1', 'age', age FROM kept""",
    "stream_rejects": f"""{LINES} SELECT CASE event_type WHEN 'error' THEN key || ',' || name
      ELSE key || ',' || name || ',' END AS line, 'too few fields' AS reject, ts, event_id AS seq
      FROM lines WHERE event_type IN ('error', 'view')""",
    "stream_latest": f"{LOG} SELECT row_key, family, qualifier, value FROM visible",
    "stream_table": f"""{LINES}, kept AS (SELECT * FROM lines WHERE event_type NOT IN ('error', 'view')
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) = 1)
      SELECT key AS row_key, 'cf1' AS family, 'name' AS qualifier, name AS value FROM kept
      UNION ALL SELECT key, 'cf1', 'age', age FROM kept
      UNION ALL SELECT 'c' || {PADDED}, 'cf1', 'name', c_name FROM customer""",
    "stream_raw_append": f"""SELECT '1' || lpad(CAST({MILLIS} AS VARCHAR), 19, '0') || '-1' ||
      lpad(CAST(event_id AS VARCHAR), 19, '0') AS row_key, 'cf1' AS family, 'name' AS qualifier, props AS value
      FROM events""",
    "stream_scan": f"""{SC} SELECT row_key, {JOINED.format(sep='_')} AS value FROM sc
      WHERE row_key >= '4' AND row_key < 'c' AND family IN ('acct', 'info') GROUP BY row_key""",
    "stream_scan_ranges": f"""{SC} SELECT row_key, {JOINED.format(sep='_')} AS value FROM sc
      WHERE row_key >= '4' AND row_key < 'c' AND family IN ('acct', 'info') GROUP BY row_key""",
    "stream_ledger": f"{LOG} SELECT row_key, family, qualifier, seq, op, value FROM el",
    "covering_index_lookup": """SELECT CAST(event_id AS VARCHAR) AS ranking, props AS url FROM events
      WHERE event_type = 'purchase'""",
    "index_join_back": f"""{CC} SELECT * FROM cc WHERE NOT {NO_NAME} AND row_key IN
      (SELECT {PADDED} FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))""",
    "index_maintained": f"""SELECT {PADDED} AS row_key,
      CASE WHEN c_acctbal >= 9000 THEN 'VIP' ELSE c_mktsegment END AS segment,
      CASE WHEN c_nationkey = 5 THEN c_name || '*' ELSE c_name END AS name
      FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
}
