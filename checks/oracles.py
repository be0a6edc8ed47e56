"""SQL for DuckDB that gives the same rows straight from the test tables."""

from __future__ import annotations

from checks.catalog import OLD_DDL
from checks.fixture import EVENT_TYPES, LIMIT, TOPIC

# The fixture's properties of every event: broken text, its type, its code.
_SRC = f"""
src AS (
  SELECT event_id, ts, user_id, value, props, event_id % 97 = 0 AS broken,
         CASE WHEN event_id % 53 = 0 THEN 'mystery' ELSE event_type END AS etype,
         CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'E1'
              WHEN event_id % 5 = 0 THEN '1' ELSE '0' END AS ec
  FROM events),
good AS (SELECT * FROM src WHERE NOT broken),
routed AS (SELECT * FROM good WHERE etype IN {EVENT_TYPES})
"""

_ROUTE_COLUMNS = f"""
  CAST(user_id AS VARCHAR) AS key, '{TOPIC}' AS topic, ts AS "eventTime", event_id,
  etype AS "eventType", user_id, value, props, ec AS error_code
"""


def _route(where: str) -> str:
    return f"WITH {_SRC} SELECT {_ROUTE_COLUMNS} FROM routed WHERE {where}"


_DECODE_FLAT = f"""
WITH {_SRC}
SELECT CAST(user_id AS VARCHAR) AS key, '{TOPIC}' AS topic,
       CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", ts AS "eventTime",
       0 AS "timestampType",
       CASE WHEN NOT broken THEN event_id END AS event_id,
       CASE WHEN NOT broken THEN etype END AS "eventType",
       CASE WHEN NOT broken THEN user_id END AS user_id,
       CASE WHEN NOT broken THEN value END AS value,
       CASE WHEN NOT broken THEN props END AS props,
       CASE WHEN NOT broken THEN ec END AS error_code
FROM src
"""

_BRONZE = f"""
WITH {_SRC}
SELECT CAST(user_id AS VARCHAR) AS key, '{TOPIC}' AS topic,
       CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", ts AS "eventTime",
       0 AS "timestampType",
       CASE WHEN NOT broken THEN etype END AS "eventType",
       CASE WHEN NOT broken THEN event_id END AS payload_event_id,
       CASE WHEN NOT broken THEN etype END AS "payload_eventType",
       CASE WHEN NOT broken THEN user_id END AS payload_user_id,
       CASE WHEN NOT broken THEN value END AS payload_value,
       CASE WHEN NOT broken THEN props END AS payload_props,
       CASE WHEN NOT broken THEN ec END AS payload_error_code,
       CASE WHEN NOT broken AND etype IN {EVENT_TYPES} THEN etype ELSE '_unrouted' END AS route,
       CASE WHEN broken OR etype IS NULL OR etype NOT IN {EVENT_TYPES} THEN '_unrouted'
            WHEN ec = '0' THEN 'valid' WHEN ec = '1' THEN 'faulty' ELSE 'undetermined' END
         AS outcome
FROM src
"""

# Codes that are numbers.
_NUMERIC = f"""
WITH {_SRC.replace("""CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'E1'
              WHEN event_id % 5 = 0 THEN '1' ELSE '0' END AS ec""", """CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 0.4
              WHEN event_id % 5 = 0 THEN -0.9 WHEN event_id % 3 = 0 THEN 2 ELSE 0 END::DOUBLE AS ec""")}
SELECT {_ROUTE_COLUMNS} FROM src WHERE etype IN {EVENT_TYPES} AND
"""

# Records with every flaw by turns.
_FLAWED = f"""
f AS (
  SELECT *, CASE WHEN event_id % 2 = 0 THEN '"oops"' ELSE event_id::VARCHAR END AS n,
         CASE event_id % 3 WHEN 0 THEN '0' WHEN 1 THEN '7' ELSE 'E1' END AS code,
         CASE WHEN event_id % 5 = 0 THEN 'untyped' WHEN event_id % 7 = 0 THEN 'unknown'
              WHEN event_id % 11 = 0 THEN 'broken' ELSE 'typed' END AS form
  FROM events),
flawed AS (
  SELECT *, CASE form
           WHEN 'untyped' THEN '{{"n":' || n || ',"error_code":"0"}}'
           WHEN 'unknown' THEN '{{"eventType":"mystery","n":' || n || '}}'
           WHEN 'broken' THEN '{{"eventType":"' || event_type
           ELSE '{{"eventType":"' || event_type || '","n":' || n || ',"error_code":"' || code
                || '"}}' END AS text,
         CASE form WHEN 'untyped' THEN 'no_type' WHEN 'unknown' THEN 'unknown_type'
           WHEN 'broken' THEN 'malformed'
           ELSE CASE WHEN code = '7' THEN 'faulty' WHEN event_id % 2 = 0 THEN 'partial'
                     WHEN code = '0' THEN 'valid' ELSE 'undetermined' END END AS reason
  FROM f)
"""

_REJECTS = f"""
WITH {_FLAWED}
SELECT 'quarantine_events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
       event_id AS "offset", reason, text AS raw
FROM flawed WHERE reason <> 'valid'
"""

_UNROUTED = f"""
WITH {_SRC}
SELECT CAST(user_id AS VARCHAR) AS key, CAST(user_id % 4 AS INTEGER) AS partition,
       event_id AS "offset", CASE WHEN NOT broken THEN etype END AS "eventType",
       CASE WHEN broken THEN 'malformed' ELSE 'unknown_type' END AS reason,
       CASE WHEN broken THEN 'broken ' || CAST(event_id AS VARCHAR) END AS raw
FROM src WHERE broken OR etype NOT IN {EVENT_TYPES}
"""

_CONSERVATION = f"""
WITH {_SRC}
SELECT CASE WHEN NOT broken THEN etype END AS "eventType", count(*) AS records,
       count(DISTINCT (user_id % 4, event_id)) AS positions
FROM src GROUP BY 1
"""


def _json(record: tuple[str, ...]) -> str:
    """JSON of a record, the error code left out where it is NULL."""
    fields = (
        *record,
        "event_id := event_id",
        '"eventType" := etype',
        "user_id := user_id",
        "value := value",
        "props := props",
    )
    without = f"to_json(struct_pack({', '.join(fields)}))"
    with_code = f"to_json(struct_pack({', '.join((*fields, 'error_code := ec'))}))"
    return f"CAST(CASE WHEN ec IS NULL THEN {without} ELSE {with_code} END AS VARCHAR)"


_KEY = "key := to_base64(CAST(CAST(user_id AS VARCHAR) AS BLOB))"
_TIME = "\"eventTime\" := strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
_MESSAGE_RECORD = (_KEY, f"topic := '{TOPIC}'", _TIME)
_POSITION_RECORD = (
    _KEY, f"topic := '{TOPIC}'", "partition := user_id % 4", '"offset" := event_id', _TIME,
)


def _messages(topic: str, where: str = "true", record: tuple[str, ...] = _MESSAGE_RECORD) -> str:
    return f"""
WITH {_SRC}
SELECT {topic} AS topic, CAST(user_id AS VARCHAR) AS key, {_json(record)} AS value
FROM routed WHERE {where}
"""


_FAULTY = "ec = '1'"
_UNDETERMINED = "ec IS NULL OR ec = 'E1'"
_QUARANTINE = _messages("'quarantine_events'", _FAULTY)
_PUBLISH_ALL = _messages(f"'kafka_sink_' || etype || '_{TOPIC}'")

_FANOUT = f"""
WITH {_SRC}, m AS (SELECT etype, {_json(())} AS value FROM src)
SELECT '{TOPIC}' AS topic, CAST(NULL AS VARCHAR) AS key, value FROM m
UNION ALL SELECT etype, NULL, value FROM m
"""

# Per topic and field, how often each JSON type occurs.
_OBSERVED = f"""
{_SRC},
docs AS (
  SELECT '{TOPIC}' AS topic, * FROM good UNION ALL SELECT etype, * FROM good),
parsed AS (
  SELECT topic, to_json(struct_pack(event_id := event_id, "eventType" := etype,
         user_id := user_id, value := value, props := props, error_code := ec)) AS j
  FROM docs),
fields AS (SELECT topic, j, unnest(json_keys(j)) AS field FROM parsed),
typed AS (
  SELECT topic, field, CASE json_type(j, '$."' || field || '"')
           WHEN 'UBIGINT' THEN 'bigint' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
           WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN 'void' END AS observed_type
  FROM fields),
profile AS (
  SELECT topic, field, observed_type, count(*) AS records FROM typed
  WHERE observed_type <> 'void' GROUP BY ALL)
"""

_SCHEMAS = f"""
{_OBSERVED},
merged AS (
  SELECT topic, field, CASE WHEN count(DISTINCT observed_type) = 1 THEN min(observed_type)
         WHEN min(observed_type) = 'bigint' AND max(observed_type) = 'double' THEN 'double'
         ELSE 'string' END AS t
  FROM profile GROUP BY topic, field),
schemas AS (
  SELECT topic, 'struct<' || string_agg(field || ':' || t, ',' ORDER BY field) || '>' AS schema_ddl
  FROM merged GROUP BY topic)
"""

_REGISTERED_TYPES = ", ".join(
    f"('{name}', '{type_}')" for name, type_ in (f.split() for f in OLD_DDL.split(", "))
)
_DRIFT = f"""
WITH {_OBSERVED},
topics AS (SELECT unnest(['{TOPIC}', {', '.join(f"'{t}'" for t in EVENT_TYPES)}]) AS topic),
registered AS (
  SELECT topic, field, registered_type
  FROM topics, (VALUES {_REGISTERED_TYPES}) r(field, registered_type))
SELECT topic, field, registered_type, observed_type, coalesce(records, 0) AS records,
       CASE WHEN observed_type IS NULL THEN 'never_seen'
            WHEN registered_type IS NULL THEN 'new_field'
            WHEN observed_type = registered_type THEN 'match'
            WHEN observed_type = 'bigint' AND registered_type = 'double' THEN 'widening'
            ELSE 'conflict' END AS verdict
FROM profile FULL OUTER JOIN registered USING (topic, field)
"""

_EVOLVING = """
SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'view')
UNION ALL BY NAME
SELECT event_id, event_type, props FROM events WHERE event_type NOT IN ('click', 'view')
"""

_NESTED = f"""
whole AS (
  SELECT event_id AS e FROM events
  WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0),
leaves AS (
  SELECT 'id' AS field, 'bigint' AS observed_type, 1 AS n FROM whole
  UNION ALL SELECT 'o.p.q', CASE WHEN e % 2 = 0 THEN 'bigint' ELSE 'double' END, 1 FROM whole
  UNION ALL SELECT 'o.s', 'string', 1 FROM whole
  UNION ALL SELECT 'l[]', 'bigint', 2 FROM whole WHERE e % 3 = 0
  UNION ALL SELECT 'l[].x', 'bigint', 1 FROM whole WHERE e % 3 = 1
  UNION ALL SELECT 'l[].x', 'string', 1 FROM whole WHERE e % 3 = 1
  UNION ALL SELECT 'l', 'array<>', 1 FROM whole WHERE e % 3 = 2
  UNION ALL SELECT 'e', 'struct<>', 1 FROM whole
  UNION ALL SELECT 'v', 'array<>', 1 FROM whole
  UNION ALL SELECT 'w', CASE WHEN e % 5 = 0 THEN 'string' ELSE 'bigint' END, 1 FROM whole),
nested AS (
  SELECT '{TOPIC}' AS topic, field, observed_type, sum(n)::BIGINT AS records
  FROM leaves GROUP BY field, observed_type)
"""

# What the nested fixture's fields are registered as, and how each observed type fits.
_NESTED_VERDICTS = """
(VALUES ('id', 'int', 'bigint', 'narrowing'), ('o.p.q', 'double', 'bigint', 'widening'),
  ('o.p.q', 'double', 'double', 'match'), ('o.s', 'string', 'string', 'match'),
  ('l[]', 'struct', 'bigint', 'conflict'), ('l[].x', 'bigint', 'bigint', 'match'),
  ('l[].x', 'bigint', 'string', 'conflict'), ('l', 'array', 'array<>', 'match'),
  ('e', 'struct', 'struct<>', 'match'), ('v', 'array', 'array<>', 'match'),
  ('w', 'bigint', 'string', 'conflict'), ('w', 'bigint', 'bigint', 'match'),
  ('e.a', 'bigint', NULL, 'never_seen'), ('v[]', 'double', NULL, 'never_seen'),
  ('gone', 'string', NULL, 'never_seen')) r(field, registered_type, observed_type, verdict)
"""

# The type of each of the nested fixture's fields, out of the messages there are.
_NESTED_TREE = f"""
whole AS (
  SELECT event_id AS e FROM events
  WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0),
kinds AS (
  SELECT CASE WHEN bool_or(e % 2 <> 0) THEN 'double' ELSE 'bigint' END AS q,
         CASE WHEN bool_or(e % 5 = 0) THEN 'string' ELSE 'bigint' END AS w,
         CASE WHEN bool_or(e % 3 = 0) AND bool_or(e % 3 = 1) THEN 'string'
              WHEN bool_or(e % 3 = 0) THEN 'bigint'
              WHEN bool_or(e % 3 = 1) THEN 'struct<x:string>' ELSE 'string' END AS l
  FROM whole HAVING count(*) > 0),
tree AS (
  SELECT '{TOPIC}' AS topic, 'struct<e:string,id:bigint,l:array<' || l || '>,o:struct<p:struct<q:'
         || q || '>,s:string>,v:array<string>,w:' || w || '>' AS schema_ddl
  FROM kinds)
"""

# The nested fixture's payloads: well-formed, and what is in their fields.
_NESTED_ROWS = """
rows AS (
  SELECT event_id AS e, user_id,
         event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0 AS good,
         CASE WHEN event_id % 97 = 0 THEN 'broken' WHEN event_id % 89 = 0 THEN '[1]'
              WHEN event_id % 83 = 0 THEN '{"a":1,"a":2}' END AS bad
  FROM events)
"""

_REG = """
reg AS (
  SELECT 't' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS topic_name,
         CASE WHEN c_custkey % 3 = 0 THEN 'p' || lpad(CAST(c_custkey % 40 AS VARCHAR), 3, '0') END
           AS pipeline_id,
         CASE WHEN c_custkey % 10 = 0 THEN 'payload_based' ELSE 'topic_based' END AS kind,
         CASE WHEN c_custkey % 10 = 0 THEN ['click', 'view'] END AS event_types
  FROM customer)
"""

_ALLOCATION = f"""
{_REG},
load AS (SELECT pipeline_id, count(*) AS c FROM reg WHERE pipeline_id IS NOT NULL
         GROUP BY pipeline_id HAVING count(*) < {LIMIT}),
slots AS (SELECT pipeline_id, row_number() OVER (ORDER BY pass, c DESC, pipeline_id) AS rn
          FROM (SELECT pipeline_id, c, unnest(range(0, {LIMIT} - c)) AS pass FROM load)),
waiting AS (SELECT topic_name, row_number() OVER (ORDER BY topic_name) AS rn
            FROM reg WHERE pipeline_id IS NULL),
total AS (SELECT count(*) AS k FROM slots),
allocation AS (
  SELECT w.topic_name, s.pipeline_id,
         CASE WHEN s.pipeline_id IS NULL
              THEN CAST(floor((w.rn - total.k - 1) / {LIMIT}.0) + 1 AS BIGINT) END AS new_group
  FROM waiting w LEFT JOIN slots s ON w.rn = s.rn CROSS JOIN total)
"""

_REGISTRY_ROW = "topic_name, pipeline_id, kind, array_to_string(event_types, ',') AS event_types"


def _targets(where: str, sink: str) -> str:
    return f"""
WITH {_REG}, chosen AS (SELECT * FROM reg WHERE {where}),
typed AS (SELECT topic_name, unnest(event_types) AS t FROM chosen WHERE kind = 'payload_based')
SELECT topic_name, 'topic_table' AS use_case, 'silver_' || topic_name AS object_name
FROM chosen WHERE kind = 'topic_based'
UNION ALL SELECT topic_name, 'payload_bronze', 'bronze_' || topic_name
FROM chosen WHERE kind = 'payload_based'
UNION ALL SELECT topic_name, 'quarantine_bronze', 'bronze_feb_' || topic_name
FROM chosen WHERE kind = 'payload_based'
UNION ALL SELECT topic_name, 'payload_table', 'silver_' || t || '_' || topic_name FROM typed
UNION ALL SELECT topic_name, 'quarantine_table', 'silver_feb_' || t || '_' || topic_name FROM typed
UNION ALL SELECT topic_name, 'outgoing_topic', {sink} FROM typed
"""


_TARGETS = _targets("true", "'kafka_sink_' || t")
_CLASHING = _TARGETS.replace(
    _REG,
    """
reg AS (
  SELECT CASE c_custkey % 4 WHEN 0 THEN 'all' WHEN 1 THEN 'click_all' WHEN 2 THEN 'Click_All'
           ELSE 'feb_view_all' END || CAST(c_custkey // 4 AS VARCHAR) AS topic_name,
         CASE WHEN c_custkey % 4 = 0 THEN 'payload_based' ELSE 'topic_based' END AS kind,
         CASE WHEN c_custkey % 4 = 0 THEN ['click', 'view', 'click'] END AS event_types
  FROM customer)
""",
)


def _collisions(plan: str) -> str:
    return f"""
SELECT object_kind, object_name, count(DISTINCT topic_name) AS topics
FROM (SELECT topic_name,
             CASE WHEN use_case = 'outgoing_topic' THEN use_case ELSE 'table' END AS object_kind,
             CASE WHEN use_case = 'outgoing_topic' THEN object_name ELSE lower(object_name) END
               AS object_name
      FROM ({plan}))
GROUP BY 1, 2 HAVING count(DISTINCT topic_name) > 1
"""


ORACLES: dict[str, str] = {
    "decode_flat": _DECODE_FLAT,
    "split_topics": f"""
WITH {_SRC}
SELECT CAST(user_id AS VARCHAR) AS key, etype AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
       event_id AS "offset", ts AS "eventTime", 0 AS "timestampType", event_id,
       etype AS "eventType", user_id, value, props, ec AS error_code
FROM routed
""",
    "bronze_payload": _BRONZE,
    **{f"route_{t}": _route(f"etype = '{t}'") for t in EVENT_TYPES},
    "route_valid": _route("ec = '0'"),
    "route_faulty": _route(_FAULTY),
    "route_undetermined": _route(_UNDETERMINED),
    "route_unrouted": _UNROUTED,
    "route_valid_numeric": _NUMERIC + "ec = 0",
    "route_faulty_numeric": _NUMERIC + "ec <> 0",
    "route_partial": f"""
WITH {_FLAWED}
SELECT CAST(user_id AS VARCHAR) AS key, '{TOPIC}' AS topic, ts AS "eventTime",
       event_type AS "eventType", CAST(NULL AS BIGINT) AS n, code AS error_code, text AS original
FROM flawed WHERE reason = 'partial'
""",
    "unrouted_reasons": f"""
WITH {_FLAWED}
SELECT CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
       CASE form WHEN 'unknown' THEN 'mystery' END AS "eventType", reason,
       CASE WHEN form = 'broken' OR event_id % 2 = 0 THEN text END AS raw
FROM flawed WHERE form <> 'typed'
""",
    "publish_rejects": f"""
SELECT topic, CAST("offset" AS VARCHAR) AS key,
       CAST(to_json(struct_pack(key := CAST("offset" AS VARCHAR), partition := partition,
            "offset" := "offset", reason := reason, raw := raw)) AS VARCHAR) AS value
FROM ({_REJECTS})
""",
    "stream_rejects": _REJECTS,
    "conservation": _CONSERVATION,
    **{f"publish_{t}": _messages(f"'kafka_sink_{t}'", f"etype = '{t}'") for t in EVENT_TYPES},
    "publish_all": _PUBLISH_ALL,
    "publish_positions": _messages("'kafka_sink_' || etype", record=_POSITION_RECORD),
    "publish_quarantine": _QUARANTINE,
    "publish_quarantine_undetermined": _messages(
        "'quarantine_events'", f"{_FAULTY} OR {_UNDETERMINED}"
    ),
    "publish_fanout": _FANOUT,
    "infer_schema": f"WITH {_SCHEMAS} SELECT topic, schema_ddl FROM schemas",
    "topic_config": f"""
WITH {_SCHEMAS}
SELECT topic, CASE WHEN topic = '{TOPIC}' THEN 'payload_based' ELSE 'topic_based' END AS kind,
       schema_ddl, CASE WHEN topic = '{TOPIC}' THEN '{','.join(EVENT_TYPES)}' END AS event_types
FROM schemas WHERE topic IN {(TOPIC, *EVENT_TYPES)}
""",
    "decode_inferred": _DECODE_FLAT,
    "field_profile": f"WITH {_OBSERVED} SELECT topic, field, observed_type, records FROM profile",
    "schema_drift": _DRIFT,
    "infer_schema_nested": f"""
SELECT '{TOPIC}' AS topic, 'struct<e:string,id:bigint,l:array<string>,'
       || 'o:struct<p:struct<q:double>,s:string>,v:array<string>,w:string>' AS schema_ddl
FROM (SELECT count(*) AS n FROM events) WHERE n > 0
""",
    "field_profile_nested": f"WITH {_NESTED} SELECT * FROM nested",
    "schema_drift_nested": f"""
WITH {_NESTED}
SELECT '{TOPIC}' AS topic, r.field, registered_type, r.observed_type,
       coalesce(records, 0) AS records, verdict
FROM {_NESTED_VERDICTS} LEFT JOIN nested
  ON nested.field = r.field AND nested.observed_type = r.observed_type
""",
    "payload_rejects": f"""
SELECT '{TOPIC}' AS topic,
       CASE WHEN event_id % 97 = 0 THEN 'malformed' WHEN event_id % 89 = 0 THEN 'not_object'
            ELSE 'repeated_key' END AS reject, count(*) AS records
FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0 GROUP BY 2
""",
    "schema_tracked": f"WITH {_NESTED_TREE} SELECT topic, schema_ddl FROM tree",
    "sample_increment": f"""
WITH {_NESTED_TREE}
SELECT topic, partition, end_offset, schema_ddl
FROM (SELECT CAST(user_id % 4 AS INTEGER) AS partition, max(event_id) + 1 AS end_offset
      FROM events GROUP BY 1), tree
""",
    "decode_hinted": f"""
WITH {_NESTED_ROWS}
SELECT e AS "offset", CASE WHEN good THEN e::INTEGER END AS id,
       CASE WHEN good THEN CASE WHEN e % 2 = 0 THEN e::VARCHAR ELSE e || '.5' END END AS q,
       CASE WHEN good THEN 'x' END AS s, NULL::VARCHAR AS more,
       CASE WHEN good THEN CASE WHEN e % 3 = 2 THEN 0 ELSE 2 END END AS l_size,
       CASE WHEN good THEN CASE e % 3 WHEN 0 THEN '1' WHEN 1 THEN '{{"x":1}}' END END AS l_first,
       CASE WHEN good THEN '{{}}' END AS e,
       CASE WHEN good THEN CASE WHEN e % 5 = 0 THEN 'oops' ELSE '5' END END AS w
FROM rows
""",
    "decode_rescued": f"""
WITH {_NESTED_ROWS}
SELECT e AS "offset", CASE WHEN good THEN e::INTEGER END AS id,
       CASE WHEN good THEN e + CASE WHEN e % 2 = 0 THEN 0 ELSE 0.5 END END::DOUBLE AS q,
       CASE WHEN good THEN CASE e % 3 WHEN 0 THEN '1,2' WHEN 2 THEN '' END END AS l,
       CASE WHEN good AND e % 5 <> 0 THEN 5::BIGINT END AS w,
       CASE WHEN good THEN '{{"e":{{}},'
              || CASE WHEN e % 3 = 1 THEN '"l":[{{"x":1}},{{"x":"t"}}],' ELSE '' END
              || '"o":{{"s":"x"}},"v":[]' || CASE WHEN e % 5 = 0 THEN ',"w":"oops"' ELSE '' END
              || '}}'
            ELSE bad END AS rescued
FROM rows
""",
    "schema_merge_read": _EVOLVING,
    "registry": f"WITH {_REG} SELECT {_REGISTRY_ROW} FROM reg",
    "registry_load": f"""
WITH {_REG} SELECT pipeline_id, count(*) AS load FROM reg WHERE pipeline_id IS NOT NULL
GROUP BY pipeline_id HAVING count(*) < {LIMIT} ORDER BY load DESC, pipeline_id
""",
    "registry_unallocated": f"""
WITH {_REG} SELECT topic_name AS topic FROM reg WHERE pipeline_id IS NULL
""",
    "registry_allocated": f"""
WITH {_REG} SELECT pipeline_id FROM reg WHERE pipeline_id IS NOT NULL
""",
    "registry_pipelines": f"""
WITH {_REG} SELECT DISTINCT pipeline_id FROM reg WHERE pipeline_id IS NOT NULL
""",
    "registry_topics": f"WITH {_REG} SELECT {_REGISTRY_ROW} FROM reg WHERE pipeline_id = 'p007'",
    "registry_allocate": f"WITH {_ALLOCATION} SELECT * FROM allocation",
    "registry_allocate_weighted": f"""
WITH {_REG},
weighed AS (
  SELECT topic_name, pipeline_id,
         1 + CASE WHEN kind = 'payload_based' THEN len(event_types) ELSE 0 END AS weight FROM reg),
room AS (
  SELECT pipeline_id, {LIMIT} - sum(weight) AS free FROM weighed
  WHERE pipeline_id IS NOT NULL GROUP BY pipeline_id HAVING sum(weight) < {LIMIT}),
line AS (
  SELECT *, sum(free) OVER (ORDER BY free DESC, pipeline_id) AS upto FROM room),
topics AS (
  SELECT topic_name, weight, sum(weight) OVER (ORDER BY weight DESC, topic_name) AS upto
  FROM weighed WHERE pipeline_id IS NULL),
dealt AS (
  SELECT t.topic_name, t.weight, l.pipeline_id FROM topics t LEFT JOIN line l
  ON t.upto - t.weight >= l.upto - l.free AND t.upto <= l.upto),
classed AS (
  SELECT *, length(bin(greatest({LIMIT} // weight, 1))) - 1 AS class FROM dealt
  WHERE pipeline_id IS NULL),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY class ORDER BY weight DESC, topic_name) - 1)
            // CAST(pow(2, class) AS BIGINT) AS place FROM classed),
classes AS (
  SELECT class, sum(max(place) + 1) OVER (ORDER BY class) - (max(place) + 1) AS earlier
  FROM placed GROUP BY class)
SELECT topic_name, weight, pipeline_id, CAST(NULL AS BIGINT) AS new_group FROM dealt
WHERE pipeline_id IS NOT NULL
UNION ALL
SELECT topic_name, weight, pipeline_id, CAST(earlier + place + 1 AS BIGINT)
FROM placed JOIN classes USING (class)
""",
    "registry_new_groups": f"""
WITH {_ALLOCATION}
SELECT new_group, string_agg(topic_name, ',' ORDER BY topic_name) AS topic_names,
       count(*) AS topics
FROM allocation WHERE new_group IS NOT NULL GROUP BY new_group
""",
    "registry_merge": f"""
WITH {_ALLOCATION}
SELECT reg.topic_name,
       coalesce(a.pipeline_id, 'new' || CAST(a.new_group AS VARCHAR), reg.pipeline_id)
         AS pipeline_id,
       kind, array_to_string(event_types, ',') AS event_types
FROM reg LEFT JOIN allocation a ON reg.topic_name = a.topic_name
""",
    "target_plan": _TARGETS,
    "target_plan_allocated": _targets(
        "pipeline_id IS NOT NULL", "'kafka_sink_' || t || '_' || topic_name"
    ),
    "target_collisions": _collisions(_TARGETS),
    "target_collisions_across_kinds": _collisions(_CLASHING),
    "topics_without_config": f"""
WITH {_REG}
SELECT topic_name AS topic, pipeline_id FROM reg
WHERE pipeline_id IS NOT NULL AND right(topic_name, 1)::INTEGER % 2 = 1
""",
    "registry_saved": f"""
WITH {_ALLOCATION}
SELECT reg.topic_name, coalesce(a.pipeline_id, reg.pipeline_id) AS pipeline_id, kind,
       array_to_string(event_types, ',') AS event_types
FROM reg LEFT JOIN allocation a ON reg.topic_name = a.topic_name
""",
    "flow_changes": f"""
WITH {_REG},
flows AS (
  SELECT *, substr(topic_name, 2)::BIGINT AS k,
         CASE WHEN kind = 'payload_based' THEN 'bronze_' ELSE 'silver_' END || topic_name AS flow
  FROM reg)
SELECT coalesce(pipeline_id, 'p' || lpad(CAST(k % 40 AS VARCHAR), 3, '0')) AS pipeline_id, flow,
       topic_name AS topic,
       CASE WHEN k % 3 <> 0 THEN 'stop' WHEN k % 5 <> 0 THEN 'start' ELSE 'keep' END AS action
FROM flows WHERE k % 3 = 0 OR k % 5 = 0
""",
    "stream_bronze": _BRONZE,
    "stream_topic_table": _DECODE_FLAT,
    "stream_routes": _route("true"),
    "stream_compacted": _BRONZE,
    "stream_table_routes": _route("true"),
    "stream_valid": _route("ec = '0'"),
    "stream_schema_merge": f"""
WITH {_SRC} SELECT {_ROUTE_COLUMNS} FROM routed WHERE ec = '0'
UNION ALL SELECT * REPLACE (NULL AS props) FROM ({_route("ec = '0'")})
""",
    "stream_catalog_merge": f"""
SELECT * REPLACE (CASE WHEN abs("offset") % 2 = 1 THEN props END AS props) FROM ({_DECODE_FLAT})
""",
    "stream_conservation": f"""
WITH {_SRC},
outcomes AS (
  SELECT CASE WHEN broken OR coalesce(etype NOT IN {EVENT_TYPES}, true) THEN '_unrouted'
              WHEN ec = '0' THEN 'valid' WHEN ec = '1' THEN 'faulty' ELSE 'undetermined' END AS o
  FROM src)
SELECT outcome, count(o) AS records, 3::BIGINT AS batches
FROM (VALUES ('valid'), ('faulty'), ('undetermined'), ('partial'), ('_unrouted')) t(outcome)
LEFT JOIN outcomes ON o = outcome GROUP BY outcome
""",
    "stream_deduplicated": f"""
WITH {_SRC}
SELECT '{TOPIC}' AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
       CASE WHEN broken THEN 'broken ' || event_id ELSE value_json END AS value
FROM (SELECT *, {_json(())} AS value_json FROM src)
""",
    "stream_quarantine": _QUARANTINE,
    "stream_publish": _PUBLISH_ALL,
    "stream_all_messages": (
        f"SELECT * FROM ({_QUARANTINE}) UNION ALL SELECT * FROM ({_PUBLISH_ALL})"
    ),
}
