"""DuckDB SQL for the same results, used as the correctness oracle.

The tables ``events`` etc. are views in DuckDB. These texts mirror the Spark
plans with plain windows; they only have to be right, not fast.
"""

from __future__ import annotations

# The line patterns that must match the reference's, in telegram
# order, written out apart from the engine's own so that a wrong pattern there
# shows (field, regular expression, group, kind).
FIELDS = [
    ("timestamp", r"^0-0:1\.0\.0\(([0-9]{12})[WS]\)", 1, "string"),
    ("electricityConsumption1", r"^1-0:1\.8\.1\(([0-9]+\.[0-9]{3})\*kWh\)", 1, "double"),
    ("electricityConsumption2", r"^1-0:1\.8\.2\(([0-9]+\.[0-9]{3})\*kWh\)", 1, "double"),
    ("electricityProduction1", r"^1-0:2\.8\.1\(([0-9]+\.[0-9]{3})\*kWh\)", 1, "double"),
    ("electricityProduction2", r"^1-0:2\.8\.2\(([0-9]+\.[0-9]{3})\*kWh\)", 1, "double"),
    ("currentTariff", r"^0-0:96\.14\.0\(([0-9]{4})\)", 1, "int"),
    ("currentConsumption", r"^1-0:1\.7\.0\(([0-9]+\.[0-9]{3})\*kW\)", 1, "double"),
    ("currentProduction", r"^1-0:2\.7\.0\(([0-9]+\.[0-9]{3})\*kW\)", 1, "double"),
    ("gasTimestamp", r"^0-1:24\.2\.1\(([0-9]{12})[WS]\)\(([0-9]+\.[0-9]{3})\*m3\)", 1, "string"),
    ("gasConsumption", r"^0-1:24\.2\.1\(([0-9]{12})[WS]\)\(([0-9]+\.[0-9]{3})\*m3\)", 2, "double"),
]


def _num(c: str) -> str:
    whole = f"CAST({c} // 1000 AS VARCHAR)"
    padded = f"(CASE WHEN length({whole}) >= 6 THEN {whole} ELSE lpad({whole}, 6, '0') END)"
    return f"({padded} || '.' || lpad(CAST({c} % 1000 AS VARCHAR), 3, '0'))"


def _p1(ts: str) -> str:
    return f"strftime({ts}, '%y%m%d%H%M%S')"


def _line(text: str, omit: str | None = None) -> str:
    body = f"(CASE WHEN event_id % 29 = 0 THEN ' ' || chr(9) ELSE '' END || {text})"
    return body if omit is None else f"(CASE WHEN NOT ({omit}) THEN {body} END)"


TELEGRAMS = f"""
fx_b AS (
  SELECT event_id, user_id AS meter_id, ts, event_type,
         CAST(round(value * 100) AS BIGINT) * 10 AS v
  FROM events),
fx_r AS (
  SELECT *,
    CAST(row_number() OVER w AS BIGINT) AS seq,
    CAST(sum(CASE WHEN event_type IN ('click','view') THEN v ELSE 0 END) OVER w AS BIGINT) AS c1,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN v ELSE 0 END) OVER w AS BIGINT) AS c2,
    CAST(sum(CASE WHEN event_type = 'signup' THEN v ELSE 0 END) OVER w AS BIGINT) AS p1,
    CAST(sum(CASE WHEN event_type = 'error' THEN v ELSE 0 END) OVER w AS BIGINT) AS p2,
    CASE WHEN event_type IN ('click','view') THEN 1 ELSE 2 END AS tariff,
    CASE WHEN event_id % 7 = 0 THEN v ELSE 0 END AS cp,
    CAST(sum(CASE WHEN event_id % 5 = 0 THEN v ELSE 0 END) OVER w AS BIGINT) AS gas
  FROM fx_b
  WINDOW w AS (PARTITION BY meter_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
fx_t AS (
  SELECT meter_id, seq, event_id, CASE WHEN event_id % 11 = 0 THEN replace(tx, chr(10), chr(13) || chr(10)) ELSE tx END AS telegram
  FROM (SELECT *, array_to_string(list_filter([
      CASE WHEN event_id % 31 = 0 THEN '!' END,
      CASE WHEN event_id % 19 = 0 THEN 'noise' END,
      '/SYN5',
      CASE WHEN event_id % 37 = 0 THEN '/XYZ5' END,
      '',
      {_line("'0-0:1.0.0(' || " + _p1("ts") + " || 'W)'", "event_id % 23 = 0")},
      {_line("'1-0:1.8.1(' || " + _num("c1") + " || '*kWh)'")},
      {_line("'1-0:1.8.2(' || " + _num("c2") + " || '*kWh)'")},
      {_line("'1-0:2.8.1(' || " + _num("p1") + " || '*kWh)'")},
      {_line("'1-0:2.8.2(' || " + _num("p2") + " || '*kWh)'")},
      {_line("'0-0:96.14.0(000' || CAST(tariff AS VARCHAR) || ')'")},
      CASE WHEN event_id % 17 = 0 THEN {_line("'1-0:1.7.0(000000.000*kW)'")} END,
      {_line("'1-0:1.7.0(' || " + _num("v") + " || '*kW)'")},
      {_line("'1-0:2.7.0(' || " + _num("cp") + " || '*kW)'")},
      {_line("'0-1:24.2.1(' || " + _p1("date_trunc('hour', ts)") + " || 'W)(' || " + _num("gas") + " || '*m3)'", "event_id % 13 = 0")},
      CASE WHEN event_id % 41 <> 0 THEN '!' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') END
    ], lambda x: x IS NOT NULL), chr(10)) AS tx
  FROM fx_r))"""

FRAMED = TELEGRAMS + r""",
fx_lines AS (
  SELECT t.meter_id, t.seq, CAST(u.ord - 1 AS BIGINT) AS line_no,
         regexp_replace(u.val, '^\s+|\s+$', '', 'g') AS line
  FROM fx_t t, unnest(string_split(t.telegram, chr(10))) WITH ORDINALITY AS u(val, ord)),
fx_f AS (
  SELECT *, seq * 100000 + line_no AS pos,
    CAST(coalesce(sum(CASE WHEN line LIKE '!%' THEN 1 ELSE 0 END) OVER (
      PARTITION BY meter_id ORDER BY seq, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS telegram_no,
    sum(CASE WHEN line LIKE '!%' THEN 1 ELSE 0 END) OVER (PARTITION BY meter_id) AS bangs
  FROM fx_lines),
fx_g AS (
  SELECT *, min(CASE WHEN line LIKE '/%' THEN pos END) OVER (PARTITION BY meter_id, telegram_no) AS first_slash
  FROM fx_f),
framed AS (
  SELECT meter_id, seq, line_no, pos, line, telegram_no FROM fx_g
  WHERE first_slash IS NOT NULL AND pos >= first_slash AND telegram_no < bangs AND line <> '')"""


def _field_sql(field: str, pattern: str, group: int, kind: str) -> str:
    zero = "''" if kind == "string" else "0"
    extracted = f"regexp_extract(line, '{pattern}', {group})"
    if kind == "double":
        extracted = f"TRY_CAST({extracted} AS DOUBLE)"
    elif kind == "int":
        extracted = f"TRY_CAST({extracted} AS INTEGER)"
    return f"coalesce(arg_max({extracted}, pos) FILTER (WHERE regexp_matches(line, '{pattern}')), {zero}) AS \"{field}\""


READINGS = FRAMED + """,
readings AS (
  SELECT meter_id, telegram_no, min(seq) AS seq,
    """ + ",\n    ".join(_field_sql(*fp) for fp in FIELDS) + """
  FROM framed GROUP BY meter_id, telegram_no)"""

ELEC = [
    "electricityConsumption1",
    "electricityConsumption2",
    "electricityProduction1",
    "electricityProduction2",
    "currentTariff",
    "currentConsumption",
    "currentProduction",
]
GASF = ["gasTimestamp", "gasConsumption"]
ALLF = ["timestamp"] + ELEC + GASF
ZERO = {f: ("''" if f in ("timestamp", "gasTimestamp") else ("0" if f == "currentTariff" else "0.0")) for f in ALLF}


def _cols(prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{f}"' for f in ALLF)


CHANGES = READINGS + """,
valid AS (SELECT * FROM readings WHERE "timestamp" <> ''),
prevd AS (
  SELECT *, """ + ", ".join(
    f'coalesce(lag("{f}") OVER w, {ZERO[f]}) AS "prev_{f}"' for f in ALLF
) + """, lag("timestamp") OVER w IS NULL AS is_first
  FROM valid WINDOW w AS (PARTITION BY meter_id ORDER BY seq)),
changes AS (
  SELECT meter_id, seq, 'electricity' AS topic, "timestamp" AS "telegramTimestamp", """ + ", ".join(
    f'CASE WHEN "{f}" <> "prev_{f}" THEN "{f}" END AS "{f}"' for f in ELEC
) + """, CAST(NULL AS VARCHAR) AS "gasTimestamp", CAST(NULL AS DOUBLE) AS "gasConsumption"
  FROM prevd WHERE is_first OR """ + " OR ".join(f'"{f}" <> "prev_{f}"' for f in ELEC) + """
  UNION ALL
  SELECT meter_id, seq, 'gas' AS topic, "timestamp" AS "telegramTimestamp", """ + ", ".join(
    f'CAST(NULL AS {"INTEGER" if f == "currentTariff" else "DOUBLE"}) AS "{f}"' for f in ELEC
) + ", " + ", ".join(f'CASE WHEN "{f}" <> "prev_{f}" THEN "{f}" END AS "{f}"' for f in GASF) + """
  FROM prevd WHERE is_first OR """ + " OR ".join(f'"{f}" <> "prev_{f}"' for f in GASF) + ")"


def with_ctes(ctes: str, select: str) -> str:
    return "WITH " + ctes.strip() + "\n" + select


def frame_telegrams() -> str:
    return with_ctes(
        FRAMED,
        """SELECT meter_id, telegram_no, CAST(count(*) AS BIGINT) AS n_lines,
       arg_min(line, pos) AS first_line, arg_max(line, pos) AS last_line, min(seq) AS seq
FROM framed GROUP BY meter_id, telegram_no""",
    )


def parse_readings() -> str:
    return with_ctes(READINGS, f"SELECT meter_id, seq, {_cols()} FROM readings WHERE \"timestamp\" <> ''")


def reject_telegrams() -> str:
    return with_ctes(
        READINGS,
        f"SELECT meter_id, seq, {_cols()}, 'missing_timestamp' AS reason FROM readings WHERE \"timestamp\" = ''",
    )


def detect_changes() -> str:
    return with_ctes(CHANGES, "SELECT * FROM changes")


PAYLOAD_KEYS = sorted(ELEC + GASF + ["processingTimestampUTC", "telegramTimestamp"])
PROCESSING_TEXT = "2024-02-01T00:00:00Z"
PROCESSING_TS = "TIMESTAMP '2024-02-01 00:00:00'"


def _json_member(k: str) -> str:
    if k == "processingTimestampUTC":
        return f"'\"{k}\":\"{PROCESSING_TEXT}\"'"
    if k in ("telegramTimestamp", "gasTimestamp"):
        return f"CASE WHEN \"{k}\" IS NOT NULL THEN '\"{k}\":\"' || \"{k}\" || '\"' END"
    return f"CASE WHEN \"{k}\" IS NOT NULL THEN '\"{k}\":' || CAST(\"{k}\" AS VARCHAR) END"


def change_messages() -> str:
    members = ", ".join(_json_member(k) for k in PAYLOAD_KEYS)
    return with_ctes(
        CHANGES,
        f"""SELECT meter_id, seq,
       CASE WHEN topic = 'electricity' THEN 'p1-electricity' ELSE 'p1-gas' END AS topic,
       CAST(meter_id AS VARCHAR) AS "key",
       '{{' || concat_ws(',', {members}) || '}}' AS value,
       {PROCESSING_TS} AS "timestamp"
FROM changes""",
    )


def rebuild_readings() -> str:
    elec = ", ".join(f'r."{f}"' for f in ELEC)
    gas = ", ".join(f'r."{f}"' for f in GASF)
    null_elec = ", ".join(
        f'CAST(NULL AS {"INTEGER" if f == "currentTariff" else "DOUBLE"}) AS "{f}"' for f in ELEC
    )
    return with_ctes(
        CHANGES,
        f"""SELECT c.meter_id, c.seq, 'p1-electricity' AS topic, r."timestamp" AS "telegramTimestamp", {elec},
       CAST(NULL AS VARCHAR) AS "gasTimestamp", CAST(NULL AS DOUBLE) AS "gasConsumption"
FROM changes c JOIN valid r ON c.meter_id = r.meter_id AND c.seq = r.seq WHERE c.topic = 'electricity'
UNION ALL
SELECT c.meter_id, c.seq, 'p1-gas' AS topic, r."timestamp" AS "telegramTimestamp", {null_elec}, {gas}
FROM changes c JOIN valid r ON c.meter_id = r.meter_id AND c.seq = r.seq WHERE c.topic = 'gas'""",
    )


RFC3339_SQL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.,][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})\z"

MESSAGES = r"""
msg_t AS (
  SELECT *,
    CASE WHEN event_type IN ('click','view','purchase') THEN 'p1-electricity'
         WHEN event_type = 'signup' THEN 'p1-gas' ELSE 'p1-unknown' END AS topic,
    CAST(user_id % 2 AS INTEGER) AS part,
    '{"currentConsumption":' || CAST(CAST(round(value * 100) AS BIGINT) * 10 AS VARCHAR)
      || ',"processingTimestampUTC":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
      || 'Z","telegramTimestamp":"' || strftime(ts, '%y%m%d%H%M%S') || '"}' AS good
  FROM events),
messages AS (
  SELECT CAST(user_id AS VARCHAR) AS "key", topic, part AS "partition",
    CAST(row_number() OVER (PARTITION BY topic, part ORDER BY event_id) - 1 AS BIGINT) AS "offset",
    ts AS "timestamp",
    CASE WHEN event_id % 97 = 0 THEN '{broken'
         WHEN event_id % 89 = 0 THEN '[1,2]'
         WHEN event_id % 83 = 0 THEN '{"telegramTimestamp":5,"processingTimestampUTC":"nope"}'
         WHEN event_id % 79 = 0 THEN '{}'
         WHEN event_id % 73 = 0 THEN good || ' trailing'
         WHEN event_id % 71 = 0 THEN 'null'
         WHEN event_id % 67 = 0 THEN '{"processingTimestampUTC":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
              || '789+02:00","telegramTimestamp":"' || strftime(ts, '%y%m%d%H%M%S') || '"}'
         WHEN event_id % 61 = 0 THEN '{"processingTimestampUTC":"2025","telegramTimestamp":"x"}'
         ELSE good END AS value
  FROM msg_t),
msg_j AS (
  SELECT *,
    CASE topic WHEN 'p1-electricity' THEN 'electricity' WHEN 'p1-gas' THEN 'gas' END AS rt,
    CASE WHEN topic NOT IN ('p1-electricity', 'p1-gas') THEN 'unknown_topic'
         WHEN value IS NULL THEN 'null_value'
         WHEN NOT json_valid(value) THEN 'malformed_json'
         WHEN json_type(value) <> 'OBJECT' THEN 'not_an_object' END AS reason,
    CASE WHEN json_valid(value) THEN value END AS jv
  FROM messages),
msg_k AS (
  SELECT *,
    CASE WHEN json_type(jv, '$.processingTimestampUTC') = 'VARCHAR' THEN jv ->> '$.processingTimestampUTC' END AS pt,
    CASE WHEN json_type(jv, '$.telegramTimestamp') = 'VARCHAR' THEN jv ->> '$.telegramTimestamp' END AS tt
  FROM msg_j),
routed AS (
  SELECT topic AS kafka_topic, "partition" AS kafka_partition, "offset" AS kafka_offset,
    "timestamp" AS kafka_timestamp,
    CASE WHEN regexp_matches(pt, 'RFC') THEN timezone('UTC',
      TRY_CAST(regexp_replace(replace(pt, ',', '.'), '(\.[0-9]{1,6})[0-9]*', '\1') AS TIMESTAMPTZ)) END
      AS processing_timestamp,
    tt AS telegram_timestamp, value AS raw_data,
    CASE WHEN reason IS NULL THEN rt END AS route, reason AS reject_reason
  FROM msg_k)""".replace("'RFC'", "'" + RFC3339_SQL + "'")

RAW7 = "kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, processing_timestamp, telegram_timestamp, raw_data"
GROUP = "'p1-data-consumer-group'"
OTHER = "'p1-audit-group'"


def _hw(group: str, at: str, where: str) -> str:
    return (
        f"SELECT {group} AS consumer_group_id, kafka_topic AS topic, kafka_partition AS \"partition\", "
        f"max(kafka_offset) AS last_offset, TIMESTAMP '{at}' AS updated_at FROM routed WHERE {where} GROUP BY 2, 3"
    )


LEDGERS = MESSAGES + f""",
old_l AS (
  {_hw(GROUP, '2024-01-16 00:00:00', "kafka_timestamp < TIMESTAMP '2024-01-16 00:00:00'")}
  UNION ALL
  {_hw(OTHER, '2024-01-08 00:00:00', "kafka_timestamp < TIMESTAMP '2024-01-08 00:00:00'")}),
upd_l AS (
  {_hw(GROUP, '2024-02-01 00:00:00', "kafka_topic = 'p1-electricity'")}
  UNION ALL
  {_hw(GROUP, '2024-02-02 00:00:00', "kafka_topic = 'p1-gas' AND kafka_timestamp < TIMESTAMP '2024-01-08 00:00:00'")}),
both_l AS (SELECT * FROM old_l UNION ALL SELECT * FROM upd_l),
up_l AS (
  SELECT consumer_group_id, topic, "partition", last_offset, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY consumer_group_id, topic, "partition"
                                 ORDER BY last_offset DESC, updated_at DESC) AS rn FROM both_l) WHERE rn = 1),
rw_l AS (
  SELECT consumer_group_id, topic, "partition", last_offset, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY consumer_group_id, topic, "partition"
                                 ORDER BY updated_at DESC, last_offset DESC) AS rn FROM both_l) WHERE rn = 1)"""

TYPED = ", ".join(
    ["json_extract_string(raw_data, '$.telegramTimestamp') AS \"telegramTimestamp\"",
     "json_extract_string(raw_data, '$.processingTimestampUTC') AS \"processingTimestampUTC\""]
    + [
        f"TRY_CAST(json_extract(raw_data, '$.{f}') AS {'INTEGER' if f == 'currentTariff' else 'DOUBLE'}) AS \"{f}\""
        for f in ELEC
    ]
)


def _roundtrip() -> str:
    body = rebuild_readings()
    ctes, select = body[len("WITH "):].split("\nSELECT c.meter_id", 1)
    inner = "SELECT c.meter_id" + select
    cols = ", ".join(f'"{f}"' for f in ELEC + GASF)
    return "WITH " + ctes + f"\nSELECT meter_id, topic, \"telegramTimestamp\", {cols} FROM ({inner}) x"


PAYLOAD_EDGES = """
SELECT event_id AS kafka_offset,
  CASE WHEN event_id % 5 <> 0 THEN 'gas' END AS route,
  CASE WHEN event_id % 5 = 0 THEN 'malformed_json' END AS reject_reason,
  strftime(ts, '%y%m%d%H%M%S') AS telegram_timestamp,
  length('{"telegramTimestamp":"old","pad":"') + 2000 + event_id % 5000
    + CASE WHEN event_id % 3 = 0 THEN 6 ELSE 0 END + length('","telegramTimestamp":"') + 12 + length('"}')
    + CASE WHEN event_id % 5 = 0 THEN 5 ELSE 0 END AS n_chars
FROM events
"""


POSITION_AUDIT = "WITH " + MESSAGES.strip() + """,
tops AS (SELECT topic, "partition", max("offset") - 20 AS last_offset FROM messages GROUP BY 1, 2),
stored AS (
  SELECT topic, "partition", "offset" FROM messages WHERE ("offset" // 25) % 7 <> 3
  UNION ALL SELECT topic, "partition", "offset" FROM messages WHERE "offset" % 101 IN (7, 8) AND ("offset" // 25) % 7 <> 3
  UNION ALL SELECT topic, "partition", "offset" + 5000000 FROM messages WHERE "offset" % 211 < 2),
seen AS (
  SELECT topic, "partition", "offset", sum(l) AS l, sum(s) AS s FROM (
    SELECT topic, "partition", "offset", 1 AS l, 0 AS s FROM messages
    UNION ALL SELECT topic, "partition", "offset", 0, 1 FROM stored) GROUP BY 1, 2, 3),
judged AS (
  SELECT seen.topic, seen."partition", "offset", CASE
    WHEN s > 1 THEN 'doubled' WHEN l = 0 THEN 'unlogged'
    WHEN s = 0 AND "offset" <= last_offset THEN 'missing' WHEN s = 0 THEN 'pending'
    WHEN "offset" > last_offset THEN 'ahead' END AS kind
  FROM seen JOIN tops ON seen.topic = tops.topic AND seen."partition" = tops."partition"),
ranged AS (
  SELECT *, "offset" - row_number() OVER (PARTITION BY topic, "partition", kind ORDER BY "offset") AS island
  FROM judged WHERE kind IS NOT NULL)
SELECT topic, "partition", kind, min("offset") AS first_offset, max("offset") AS last_offset
FROM ranged GROUP BY topic, "partition", kind, island"""


def registry() -> dict[str, str]:
    return {
        "frame_telegrams": frame_telegrams(),
        "parse_readings": parse_readings(),
        "reject_telegrams": reject_telegrams(),
        "detect_changes": detect_changes(),
        "change_messages": change_messages(),
        "route_messages": with_ctes(
            MESSAGES, "SELECT kafka_topic, kafka_partition, kafka_offset, route, reject_reason FROM routed"
        ),
        "rejected_messages": with_ctes(
            MESSAGES,
            "SELECT kafka_topic, kafka_partition, kafka_offset, reject_reason, raw_data FROM routed "
            "WHERE reject_reason IS NOT NULL",
        ),
        "raw_electricity": with_ctes(MESSAGES, f"SELECT {RAW7} FROM routed WHERE route = 'electricity'"),
        "raw_gas": with_ctes(MESSAGES, f"SELECT {RAW7} FROM routed WHERE route = 'gas'"),
        "raw_zero_fill": with_ctes(
            MESSAGES,
            "SELECT route, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, "
            "coalesce(processing_timestamp, TIMESTAMP '0001-01-01 00:00:00') AS processing_timestamp, "
            "coalesce(telegram_timestamp, '') AS telegram_timestamp, raw_data FROM routed WHERE reject_reason IS NULL",
        ),
        "high_water": with_ctes(
            MESSAGES,
            'SELECT kafka_topic AS topic, kafka_partition AS "partition", max(kafka_offset) AS last_offset '
            "FROM routed GROUP BY 1, 2",
        ),
        "upsert_ledger": with_ctes(LEDGERS, "SELECT * FROM up_l"),
        "upsert_ledger_rewind": with_ctes(LEDGERS, "SELECT * FROM rw_l"),
        "last_offsets": with_ctes(
            LEDGERS,
            f"""SELECT t.topic, l."partition", l.last_offset
FROM (VALUES ('p1-electricity'), ('p1-gas'), ('p1-water')) AS t(topic)
LEFT JOIN (SELECT * FROM up_l WHERE consumer_group_id = {GROUP}) l ON t.topic = l.topic""",
        ),
        "resume": with_ctes(
            LEDGERS,
            f"""SELECT m.topic, m."partition", m."offset" FROM messages m
LEFT JOIN (SELECT * FROM old_l WHERE consumer_group_id = {GROUP} AND topic IN ('p1-electricity', 'p1-gas')) l
  ON m.topic = l.topic AND m."partition" = l."partition"
WHERE l.last_offset IS NULL OR m."offset" > l.last_offset""",
        ),
        "dedup_raw": with_ctes(MESSAGES, f"SELECT {RAW7} FROM routed WHERE route = 'electricity'"),
        "typed_payload": with_ctes(
            MESSAGES, f"SELECT kafka_partition, kafka_offset, {TYPED} FROM routed WHERE route = 'electricity'"
        ),
        "rebuild_readings": rebuild_readings(),
        "capture_files": with_ctes(
            READINGS, f"SELECT meter_id, telegram_no, {_cols()} FROM readings"
        ),
        "table_setup": with_ctes(MESSAGES, f"SELECT {RAW7} FROM routed WHERE route = 'electricity'"),
        "stream_ingest": with_ctes(MESSAGES, f"SELECT route, {RAW7} FROM routed WHERE reject_reason IS NULL"),
        "stream_positions": with_ctes(
            MESSAGES,
            f'SELECT {GROUP} AS consumer_group_id, kafka_topic AS topic, kafka_partition AS "partition", '
            "max(kafka_offset) AS last_offset FROM routed GROUP BY 2, 3",
        ),
        "stream_changes": detect_changes(),
        "payload_edges": PAYLOAD_EDGES,
        "committed_rows": with_ctes(
            MESSAGES, f"SELECT route, {RAW7} FROM routed WHERE reject_reason IS NULL AND kafka_offset % 4 <> 3"
        ),
        "compacted_days": with_ctes(
            MESSAGES, f"SELECT route, {RAW7}, CAST(kafka_timestamp AS DATE) AS day FROM routed WHERE reject_reason IS NULL"
        ),
        "ledger_rewind_log": with_ctes(
            MESSAGES,
            f'SELECT {GROUP} AS consumer_group_id, kafka_topic AS topic, kafka_partition AS "partition", '
            "max(kafka_offset) FILTER (WHERE kafka_topic <> 'p1-electricity' OR kafka_offset <= 50) AS last_offset, "
            "CASE WHEN kafka_topic = 'p1-electricity' THEN 1 ELSE 0 END AS epoch FROM routed GROUP BY 2, 3",
        ),
        "position_audit": POSITION_AUDIT,
        "stream_dedup": with_ctes(MESSAGES, f"SELECT {RAW7} FROM routed WHERE route = 'electricity'"),
        "stream_rebuild": rebuild_readings(),
        "publish_roundtrip": _roundtrip(),
    }
