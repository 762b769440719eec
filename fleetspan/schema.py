"""Schemas of the captured inputs and of the results, as Spark DDL."""

RESPONSES = (
    "resource_key STRING, ts TIMESTAMP, code INT, headers MAP<STRING, ARRAY<STRING>>, body STRING, "
    "elapsed_ms BIGINT, content_length BIGINT, last_modified BIGINT"
)
DEFINITIONS = (
    "resource_type STRING, metric STRING, data_type STRING, measurement_type STRING, units STRING, "
    "interval_ms BIGINT, display_type STRING, default_on BOOLEAN"
)
VARBINDS = (
    "agent STRING, ts TIMESTAMP, oid STRING, type STRING, value STRING, is_exception BOOLEAN"
)
TRAPS = (
    "trap_id BIGINT, ts TIMESTAMP, version INT, peer_is_ip BOOLEAN, peer_host STRING, peer_address STRING, "
    "generic INT, specific INT, enterprise STRING, uptime_ticks BIGINT, trap_oid STRING, "
    "varbinds ARRAY<STRUCT<oid: STRING, type: STRING, value: STRING>>"
)
MIB = (
    "name STRING, oid STRING, syntax STRING, readable BOOLEAN, status STRING, codes MAP<INT, STRING>, "
    "index_names ARRAY<STRING>, descr STRING, table_name STRING"
)
COMMAND_RUNS = (
    "host STRING, command STRING, args STRING, exit_code INT, stdout STRING, elapsed_ns BIGINT, ts TIMESTAMP"
)
PROCESSES = (
    "host STRING, pid BIGINT, basename STRING, argv ARRAY<STRING>, cwd STRING, env MAP<STRING, STRING>, "
    "pidfile STRING"
)
ATTRIBUTES = "host STRING, bean STRING, attribute STRING, value STRING, ts TIMESTAMP"
SETTINGS = "host STRING, scope STRING, service STRING, key STRING, values ARRAY<STRING>"
LISTING = "path STRING, length BIGINT, mtime TIMESTAMP, is_dir BOOLEAN, readable BOOLEAN"
RULES = (
    "rule_order INT, generic INT, specific INT, enterprise STRING, trap_oid STRING, varbind STRING, "
    "value STRING, severity STRING"
)

MEASUREMENTS = "resource_type STRING, resource_key STRING, metric STRING, ts TIMESTAMP, value DOUBLE"
TRAITS = "resource_type STRING, resource_key STRING, metric STRING, ts TIMESTAMP, value STRING"
EVENTS = "type STRING, source STRING, ts TIMESTAMP, severity STRING, detail STRING"
INVENTORY = (
    "type STRING, key STRING, name STRING, version STRING, description STRING, "
    "config MAP<STRING, STRING>, parent_key STRING"
)
