"""Golden values of the DataFrame operators."""

import datetime

import pytest
from pyspark.sql import functions as F

from fleetspan import schema
from fleetspan.operators import availability as AV
from fleetspan.operators import config as CF
from fleetspan.operators import counters as CT
from fleetspan.operators import events as EV
from fleetspan.operators import groups as G
from fleetspan.operators import inventory as V
from fleetspan.operators import jobs as J
from fleetspan.operators import paths as P
from fleetspan.operators import report as R
from fleetspan.operators import snmp as S
from fleetspan.session import local_table

DAY = datetime.datetime(2013, 6, 3)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- availability ------------------------------------------------------------


@pytest.mark.parametrize(
    "code, expected, pattern, up", [(200, 200, None, True), (500, 200, None, False), (500, None, None, True), (200, None, "zucchini", False), (200, 200, "apple", True), (None, None, None, False)]
)
def test_response_up(spark, code, expected, pattern, up):
    df = spark.createDataFrame([(code, "apple: 42")], "code INT, body STRING")
    found = df.select(
        AV.response_up(F.col("code"), F.col("body"), F.lit(expected).cast("int"), pattern).alias("up"),
        AV.response_reason(F.col("code"), F.col("body"), F.lit(expected).cast("int"), pattern).alias("why"),
    ).first()
    assert found.up is up
    assert (found.why is None) is up


@pytest.mark.parametrize("flag, on", [(None, True), ("true", True), ("TRUE", True), ("false", False), ("no", False)])
def test_enabled(spark, flag, on):
    assert spark.range(1).select(AV.enabled(F.lit(flag).cast("string"))).first()[0] is on


# --- counters ----------------------------------------------------------------


def test_hit_ratio_and_reset(spark):
    data = [(10, 5), (12, 6), (12, 6), (1, 0), (0, 0), (0, 4)]
    df = spark.createDataFrame([("s", DAY + datetime.timedelta(minutes=i), h, m) for i, (h, m) in enumerate(data)], "server STRING, ts TIMESTAMP, hits BIGINT, misses BIGINT")
    found = [r["ratio"] for r in CT.delta_ratio(df, ["server"], "ts", "hits", "misses").orderBy("ts").collect()]
    assert found == pytest.approx([10 / 15, 2 / 3, 0.0])


def test_rate_after_reset(spark):
    df = spark.createDataFrame([("s", DAY + datetime.timedelta(seconds=10 * i), v) for i, v in enumerate([5, 25, 4])], "k STRING, ts TIMESTAMP, v BIGINT")
    by_value = CT.counter_rate(df, ["k"], "ts", "v").orderBy("ts").collect()
    assert [(r["delta"], r["rate"]) for r in by_value] == [(None, None), (20, 2.0), (4, 0.4)]
    by_null = CT.counter_rate(df, ["k"], "ts", "v", on_reset="null").orderBy("ts").collect()
    assert [r["delta"] for r in by_null] == [None, 20, None]


def test_copies_of_a_sample_are_merged(spark):
    df = spark.createDataFrame([("s", DAY, 1, 5), ("s", DAY, 2, 7)], "k STRING, ts TIMESTAMP, seq INT, v INT")
    assert rows(CT.one_per_time(df, ["k"], "ts", ["seq"], ["v"]), "k", "v") == [("s", 7)]


# --- groups ------------------------------------------------------------------


def test_group_sum(spark):
    data = [("x:type=sink-1", "n", "2"), ("x:type=sink-2", "n", "3.5"), ("x:type=sink-2", "n", "bad"), ("x:type=sink", "n", "9"), ("y-1", "n", None)]
    df = spark.createDataFrame(data, "bean STRING, attribute STRING, value STRING")
    out = G.group_sum(G.matching_beans(df, "x:type=%kind%"), G.group_name(F.col("bean")))
    assert rows(out, "group_name", "attribute", "value", "members") == [("x:type=sink*", "n", 5.5, 2)]


# --- rules and traps ---------------------------------------------------------


def trap(spark, version=1, generic=None, specific=None, enterprise=None, trap_oid=None, varbinds=(), **extra):
    base = dict(trap_id=1, ts=DAY, version=version, peer_is_ip=True, peer_host="h", peer_address="1.2.3.4", generic=generic, specific=specific, enterprise=enterprise, uptime_ticks=0, trap_oid=trap_oid, varbinds=list(varbinds))
    base.update(extra)
    return spark.createDataFrame([tuple(base[c.strip().split(" ")[0]] for c in ("trap_id ts version peer_is_ip peer_host peer_address generic specific enterprise uptime_ticks trap_oid varbinds").split())], schema.TRAPS)


def severity(spark, rule, compat=False, **fields):
    return EV.classify(trap(spark, **fields), [rule], default=None, compat=compat).first()["severity"]


def test_rule_conditions(spark):
    assert severity(spark, EV.Rule("FATAL", generic=3), generic=3) == "FATAL"
    assert severity(spark, EV.Rule("FATAL", generic=3), generic=2) is None
    assert severity(spark, EV.Rule("FATAL", generic=3, specific=9), generic=3, specific=8) is None
    assert severity(spark, EV.Rule("WARN", enterprise="1.2.2"), enterprise="1.2.2.7") == "WARN"
    assert severity(spark, EV.Rule("WARN", enterprise="1.2.2"), enterprise="1.2.22") is None
    rule = EV.Rule("INFO", varbind="1.2.3", value="foo.*bar")
    assert severity(spark, rule, varbinds=[("1.2.3", "OctetString", "foodbar")]) == "INFO"
    assert severity(spark, rule, varbinds=[("1.2.3.0", "OctetString", "fobar")]) is None
    assert severity(spark, rule) is None


def test_v2_rule_and_its_inverted_form(spark):
    rule = EV.Rule("ERROR", trap_oid="1.3.6.1.6.3.1.1.5.3")
    up, down = "1.3.6.1.6.3.1.1.5.4", "1.3.6.1.6.3.1.1.5.3"
    assert severity(spark, rule, version=2, trap_oid=down) == "ERROR"
    assert severity(spark, rule, version=2, trap_oid=up) is None
    assert severity(spark, rule, compat=True, version=2, trap_oid=down) is None
    assert severity(spark, rule, compat=True, version=2, trap_oid=up) == "ERROR"


def test_first_rule_wins_and_default(spark):
    df = trap(spark, generic=2)
    assert EV.classify(df, [EV.Rule("A", generic=2), EV.Rule("B", generic=2)]).first()["severity"] == "A"
    assert EV.classify(df, []).first()["severity"] == "INFO"
    assert [EV.classify(trap(spark, generic=g), EV.template_rules()).first()["severity"] for g in range(7)] == "WARN WARN ERROR INFO WARN ERROR WARN".split()
    many = [EV.Rule(f"R{i}", generic=i) for i in range(130)]
    assert EV.classify(trap(spark, generic=120), many).first()["severity"] == "R120"


def test_rules_from_table(spark):
    df = spark.createDataFrame([(2, None, None, None, None, None, None, "B"), (1, 3, None, None, None, None, None, "A")], schema.RULES)
    assert EV.rules_from(df) == [EV.Rule("A", generic=3), EV.Rule("B")]


MIB = [("alertName", "1.9.1", None), ("alertSeverity", "1.9.2", None), ("adminState", "1.9.3", {1: "up", 2: "down"}), ("acme", "1.8", None)]


def mib(spark):
    return spark.createDataFrame([(n, o, "x", True, "current", c, None, None, None) for n, o, c in MIB], schema.MIB)


def test_trap_event(spark):
    bound = [("1.9.1.0", "OctetString", "2013-06-03 22:23:38,858 hello – world"), ("1.9.2.0", "OctetString", "medium"), ("1.5.5.0", "OctetString", "example.org")]
    out = EV.decode_traps(trap(spark, version=2, varbinds=bound), mib(spark), pattern=r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d,\d+ ", source_oid="1.5.5").first()
    assert (out.type, out.source, out.severity) == ("Trap", "example.org", "INFO")
    assert out.detail == "alertName: hello – world\nalertSeverity: medium\n1.5.5: example.org\n"


def test_v1_trap_header_codes_and_omitted(spark):
    bound = [("1.9.3.0", "Integer32", "2"), ("1.9.3.0", "Integer32", "7"), ("1.7.7.0", "TimeTicks", "5"), ("1.1.1", "OID", "1.9.1.0")]
    df = trap(spark, generic=6, specific=1, enterprise="1.8.4", uptime_ticks=6123, varbinds=bound)
    out = EV.decode_traps(df, mib(spark), omitted=["1.7.7"]).first()
    assert out.detail == "Traptype (generic, specific): 6, 1\nTimestamp: 0:01:01.23\nEnterprise: acme.4\nadminState: down\nadminState: 7\n1.1.1: alertName.0\n"


def sized(df):
    """The rows as a table whose size Spark knows."""
    return local_table(df.sparkSession, [tuple(r) for r in df.collect()], df.schema)


def test_traps_decode_alike_with_constants_and_joins(spark, monkeypatch):
    bound = [("1.9.3.0", "Integer32", "2"), ("1.9.3.4", "Integer32", "x"), ("1.9.3", "Integer32", None), ("1.1.1", "OID", "1.9.1.0"), (None, "OID", None)]
    bound += [("1.7.7.0", "TimeTicks", "5"), ("1.9.30.1", "OctetString", "no entry"), ("1.8", "OID", "9.9"), ("", None, "")]
    traps = trap(spark, generic=6, specific=1, enterprise="1.8.4", uptime_ticks=6123, varbinds=bound)
    traps = traps.union(traps).union(trap(spark, version=2, varbinds=bound[:3])).union(trap(spark, version=2)).union(trap(spark, version=1))
    twice = sized(mib(spark).union(mib(spark).where("name = 'acme'").withColumn("name", F.lit("zeta"))))
    for omitted in ([], ["1.7.7"]):
        found = []
        for limit in (256, 0):
            monkeypatch.setattr(S, "MAX_CONSTANTS", limit)
            assert (S.constants(twice) is None) == (limit == 0)
            found.append(sorted(map(str, EV.decode_traps(traps, twice, omitted=omitted, pattern="[0-9]{4}").collect())))
        assert found[0] == found[1] and len(found[0]) == 4


def test_dictionaries_that_are_no_constants(spark):
    rows = mib(spark)
    assert S.constants(sized(rows)).names == {3: {"1.9.1": "alertName", "1.9.2": "alertSeverity", "1.9.3": "adminState"}, 2: {"1.8": "acme"}}
    assert S.constants(sized(rows.withColumn("name", F.when(F.col("name") != "acme", F.col("name"))))) is None
    other = rows.withColumn("codes", F.when(F.col("name") == "adminState", F.create_map(F.lit(1), F.lit("on"))))
    assert S.constants(sized(rows.union(other))) is None


def test_trap_without_variables(spark):
    assert EV.decode_traps(trap(spark, version=2), mib(spark)).first()["detail"] == ""


def test_trap_sources(spark):
    def source(**f):
        return trap(spark, **f).select(EV.trap_source()).first()[0]

    assert source() == "h"
    assert source(peer_host=None) == "1.2.3.4"
    assert source(peer_host=None, peer_address=None) == "unknown"
    assert source(peer_is_ip=False) == "snmp-agent"


def test_exit_events(spark):
    runs = [("a", 1, 1, ""), ("a", 2, 1, ""), ("b", 1, 2, "bad"), ("c", 1, 0, ""), ("d", 1, 0, ""), ("d", 2, 9, "x"), ("d", 3, 1, ""), ("d", 4, 0, "")]
    df = spark.createDataFrame(runs, "check STRING, n INT, code INT, output STRING")
    out = EV.exit_events(df, ["check"], ["n"], "code", F.col("output"))
    assert rows(out, "check", "n", "severity", "detail") == [("a", 1, "WARN", "exit code 1"), ("b", 1, "ERROR", "bad"), ("d", 3, "WARN", "exit code 1"), ("d", 4, "INFO", "exit code 0")]


# --- dictionaries ------------------------------------------------------------


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_longest_prefix_both_ways(spark, threshold):
    """The looked-up and the joined way agree, with a deeper sibling that must not hide an ancestor."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        probes = [("1.3.6.1.2.1.1.3.0",), ("1.3.6.1.2.1.1.3.1.2.3",), ("1.2.3",), ("1.3",), ("1.3.5.9.9",), ("1.3.55",), (None,), ("1.3.5.9.9",)]
        df = spark.createDataFrame(probes, "oid STRING")
        known = spark.createDataFrame([("sysUpTime", "1.3.6.1.2.1.1.3"), ("iso", "1.3"), ("five", "1.3.5"), ("deep", "1.3.5.9.8.7"), ("five", "1.3.5")], "name STRING, oid STRING")
        out = S.oid_names(df, known)
        assert rows(out, "oid", "oid_name") == sorted(
            [("1.3.6.1.2.1.1.3.0", "sysUpTime.0"), ("1.3.6.1.2.1.1.3.1.2.3", "sysUpTime.1.2.3"), ("1.2.3", "1.2.3"), ("1.3", "iso"), ("1.3.5.9.9", "five.9.9"), ("1.3.5.9.9", "five.9.9"), ("1.3.55", "iso.55"), (None, None)],
            key=repr,
        )
        empty = S.oid_names(df, known.limit(0))
        assert rows(empty, "oid", "oid_name") == rows(df, "oid", "oid")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_many_prefix_lengths(spark):
    keys = [(".".join(["1"] * n), f"n{n}") for n in range(1, 60)]
    known = spark.createDataFrame(keys, "oid STRING, name STRING")
    df = spark.createDataFrame([(".".join(["1"] * 45) + ".2",)], "oid STRING")
    assert S.oid_names(df, known).first()["oid_name"] == "n45.2"


def test_name_oids(spark):
    known = spark.createDataFrame([("sysUpTime", "1.3.6.1.2.1.1.3")], "name STRING, oid STRING")
    df = spark.createDataFrame([("sysUpTime.0",), ("sysUpTime",), ("1.2.3",), ("none.1",)], "oid_name STRING")
    assert rows(S.name_oids(df, known), "oid_name", "oid") == [("1.2.3", "1.2.3"), ("none.1", None), ("sysUpTime", "1.3.6.1.2.1.1.3"), ("sysUpTime.0", "1.3.6.1.2.1.1.3.0")]


def test_row_assembly_and_composition(spark):
    cols = spark.createDataFrame([("1.5.1", "low"), ("1.5.2", "high"), ("1.5.3", "label")], "oid STRING, name STRING")
    data = [("a", "1.5.1.7", "42", False), ("a", "1.5.2.7", "4", False), ("a", "1.5.3.7", "x", False), ("a", "1.5.1.8", "1", False), ("a", "1.5.2.8", "0", True), ("a", "1.9.1", "z", False), ("a", "1.5.1", "bare", False)]
    readings = spark.createDataFrame(data, "agent STRING, oid STRING, value STRING, is_exception BOOLEAN")
    table = S.assemble_rows(S.table_cells(readings, cols), ["agent", "row_index"], ["low", "high", "label"])
    out = S.composed_columns(table, ["low^high"])
    assert rows(out, "row_index", "label", F.col("low^high").cast("bigint")) == [("7", "x", 17179869226), ("8", None, None)]


def test_error_reports(spark):
    data = [(1, "1.3.6.1.6.3.15.1.1.2.0"), (2, "1.3.6.1.6.3.15.1.1.2.0"), (2, "1.3"), (3, "1.3")]
    df = spark.createDataFrame(data, "id INT, oid STRING")
    assert rows(S.error_reports(df, ["id"]), "id", "error") == [(1, "usmStatsNotInTimeWindows")]


def test_publishable_symbols(spark):
    data = [("a", "current", True, None), ("b", "obsolete", True, None), ("c", "current", False, None), ("col", "current", True, "t"), ("t", "current", True, None), ("n", None, True, None)]
    df = spark.createDataFrame(data, "name STRING, status STRING, readable BOOLEAN, table_name STRING")
    assert rows(S.publishable(df), "name") == [("a",), ("n",)]


# --- configuration -----------------------------------------------------------

VD = """{"host1": {"fleet": {"monitor": {"group": ["p"], "timeout": ["6", "0"], "env": {"PATH": ["/bin"], "A": ["host"]},
 "service": {"truth": {"version": ["1", ".0"], "args": ["-w", "5"], "env": {"A": ["svc"]}}, "bogus": {"enabled": ["false"]},
 "slow": {"timeout": ["99"], "description": ["takes ", "time"]}}}}}, "host2": {"other": {}}}"""


def services(spark, body=VD):
    df = spark.createDataFrame([(body,)], "body STRING")
    return CF.service_settings(df, "body", "fleet")


def test_service_settings(spark):
    found = {r["service"]: (r["settings"], r["args"]) for r in services(spark).collect()}
    assert found["truth"] == ({"group": "p", "timeout": "60", "version": "1.0", "env.PATH": "/bin", "env.A": "svc", "enabled": "true"}, ["-w", "5"])
    assert found["bogus"][0]["enabled"] == "false"
    assert found["slow"][0]["timeout"] == "99"
    assert found["slow"][1] == []


def test_settings_table(spark):
    df = spark.createDataFrame([(VD,)], "body STRING")
    found = rows(CF.config_settings(df, "body", "fleet"), "host", "scope", "service", "key", CF.flat_value(F.col("values")))
    assert ("host1", "host", None, "timeout", "60") in found
    assert ("host1", "host.env", None, "A", "host") in found
    assert ("host1", "service", "truth", "version", "1.0") in found
    assert ("host1", "service.env", "truth", "A", "svc") in found
    assert len(found) == 10


def test_enabled_services_become_resources(spark):
    out = V.service_resources(services(spark))
    assert rows(out, "key", "version", "description", "parent_key") == [("slow", None, "takes time", "host1"), ("truth", "1.0", None, "host1")]


def test_removed_service_reports_disabled_but_up(spark):
    known = spark.createDataFrame([("host1", "truth"), ("host1", "bogus"), ("host1", "gone")], "host STRING, service STRING")
    assert rows(CF.watched_services(known, services(spark)), "service", "enabled", "up") == [("bogus", "false", True), ("gone", "false", True), ("truth", "true", True)]


def test_overlay(spark):
    base = spark.createDataFrame([("r", "a", "1"), ("r", "b", "2")], "r STRING, k STRING, value STRING")
    over = spark.createDataFrame([("r", "b", "3"), ("r", "c", "4")], "r STRING, k STRING, value STRING")
    assert rows(CF.overlay(base, over, ["r", "k"]), "k", "value") == [("a", "1"), ("b", "3"), ("c", "4")]


def test_config_changes(spark):
    df = spark.createDataFrame([("h", 1, "x"), ("h", 2, "x"), ("h", 3, "y"), ("g", 1, "x")], "host STRING, n INT, content STRING")
    assert rows(CF.config_changes(df, ["host"], ["n"], F.col("content")), "host", "n", "changed") == [("g", 1, False), ("h", 1, False), ("h", 2, False), ("h", 3, True)]


# --- reports -----------------------------------------------------------------


def test_report_falls_through(spark):
    wanted = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "metric STRING, data_type STRING")
    first = spark.createDataFrame([("r", "a", 1.0), ("r", "b", None)], "resource_key STRING, metric STRING, value DOUBLE")
    second = spark.createDataFrame([("r", "a", 9.0), ("r", "b", 2.0), ("r", "z", 3.0)], "resource_key STRING, metric STRING, value DOUBLE")
    assert rows(R.report(wanted, first, second), "metric", "value") == [("a", 1.0), ("b", 2.0)]


def test_contract(spark):
    definitions = spark.createDataFrame([("t", "a"), ("t", "b"), ("u", "c")], "resource_type STRING, metric STRING")
    reported = spark.createDataFrame([("t", "r1", "a"), ("t", "r1", "z"), ("t", "r2", "a"), ("t", "r2", "b"), ("t", "r3", "z")], "resource_type STRING, resource_key STRING, metric STRING")
    missing, unexpected = R.contract(definitions, reported)
    assert rows(missing, "resource_key", "metric") == [("r1", "b"), ("r3", "a"), ("r3", "b")]
    assert rows(unexpected, "resource_key", "metric") == [("r1", "z"), ("r3", "z")]


def test_report_map(spark):
    df = spark.createDataFrame([("r", "a", 1.0), ("r", "b", None), ("s", "b", 2.0), ("s", "z", 3.0)], "r STRING, metric STRING, value DOUBLE")
    assert {r["r"]: r["report"] for r in R.report_map(df, ["r"], ["a", "b"]).collect()} == {"r": {"a": 1.0}, "s": {"b": 2.0}}


def test_ranked_lookup(spark):
    df = spark.createDataFrame([("k1", "n1", "t1"), ("k2", "t1", "t2"), ("k3", "n3", "t1")], "key STRING, name STRING, type STRING")
    wanted = spark.createDataFrame([("t1",), ("t2",), ("k3",), ("none",)], "wanted STRING")
    assert rows(R.ranked_lookup(wanted, df), "wanted", "rank", "key") == [("k3", 2, "k3"), ("t1", 0, "k2"), ("t2", 1, "k2")]


# --- jobs --------------------------------------------------------------------


def test_job_status(spark):
    d = datetime.datetime
    data = [
        ("a", 1, "SUCCEEDED", d(2020, 1, 1), d(2020, 1, 2)), ("a", 2, "FAILED", d(2020, 1, 3), d(2020, 1, 4)), ("a", 3, "RUNNING", d(2020, 1, 5), None),
        ("b", 4, "KILLED", d(2020, 1, 1), d(2020, 1, 2)), ("c", 5, "PREP", None, None),
    ]
    df = spark.createDataFrame(data, "app_name STRING, run_id INT, status STRING, created_time TIMESTAMP, end_time TIMESTAMP")
    day = 86_400_000
    out = J.job_status(df, F.lit("2020-01-06").cast("timestamp"))
    assert rows(out, "app_name", "run_id", "prior_status", "elapsed_ms", "recency_ms", "up") == [
        ("a", 3, "FAILED", day, 4 * day, True), ("b", 4, None, day, None, False), ("c", 5, None, None, None, True),
    ]


# --- paths -------------------------------------------------------------------


def test_subtree_rollup(spark):
    data = [("/a", 0, True, True), ("/a/b", 0, True, False), ("/a/b/f", 5, False, True), ("/a/g", 7, False, True)]
    df = spark.createDataFrame(data, "path STRING, length BIGINT, is_dir BOOLEAN, readable BOOLEAN")
    assert rows(P.subtree_rollup(df).filter("ancestor = '/a'"), "size", "files", "directories", "unreadable") == [(12, 2, 2, 1)]
    assert rows(P.subtree_rollup(df, depth=1).filter("ancestor = '/a'"), "size", "files", "directories") == [(7, 1, 2)]


FSCK = "Status\n..../a/b/file.1.tmp 0 bytes, 0 block(s), OPENFORWRITE: ../a/b/file.2 12 bytes, OK\n"


@pytest.mark.parametrize("minutes, size, count", [(0, 10, 0), (5, 10, 1), (5, 0, 0)])
def test_open_files(spark, minutes, size, count):
    opened = P.open_paths(spark.createDataFrame([(FSCK,)], "body STRING"), "body")
    assert rows(opened, "path") == [("/a/b/file.1.tmp",)]
    listing = spark.createDataFrame([("/a/b/file.1.tmp", size, DAY)], "path STRING, length BIGINT, mtime TIMESTAMP")
    as_of = F.lit(DAY + datetime.timedelta(minutes=minutes))
    assert P.open_files(opened, listing, as_of, min_size=0).count() == count


# --- inventory ---------------------------------------------------------------

REPL = '{"set":"s","myState":1,"members":[{"name":"a","state":2},{"name":"b","state":1,"self":true},{"name":"c","state":2}]}'


def test_replica_members(spark):
    from fleetspan.functions import replica as RP

    df = spark.createDataFrame([(REPL,), ('{"members":[]}',)], "body STRING")
    found = df.select(RP.self_member(F.col("body")).alias("me"), RP.primary_member(F.col("body")).alias("primary"), RP.replica_state(F.col("body")).alias("state")).collect()
    assert (found[0].me["name"], found[0].primary["name"], found[0].state) == ("b", "b", "PRIMARY")
    assert (found[1].me, found[1].primary, found[1].state) == (None, None, "UNKNOWN")


def test_process_queries(spark):
    data = [
        ("h", 1, "java", ["java", "-cp", "/usr/lib/flume-ng/x.jar", "M"], "/", {}, None), ("h", 2, "java", ["java", "-cp", "/other"], "/", {}, None),
        ("h", 3, "java", ["java", "-Doozie.http.port=1"], "/", {}, None), ("h", 4, "splunkd", ["splunkd", "-p", "8089", "start"], "/", {"SPLUNK_HOME": "/opt/s"}, None),
        ("h", 5, "x", ["x"], "/", {}, "/var/run/oozie/oozie.pid"),
    ]
    df = spark.createDataFrame(data, schema.PROCESSES)

    def pids(kind):
        return [r["pid"] for r in V.process_scan(df, V.PROCESS_QUERIES[kind]).orderBy("pid").collect()]

    assert pids("collector") == [1]
    assert pids("workflow port") == [3]
    assert pids("workflow pid") == [5]
    assert pids("log indexer") == [4]
    out = V.server_resources(df, "log indexer").first()
    assert (out.key, out.config) == ("8089", {"port": "8089", "home": "/opt/s"})


def test_key_value_server_reads_its_file(spark):
    df = spark.createDataFrame([("h", 1, "redis-server", ["redis-server", "r.conf"], "/srv", {}, None)], schema.PROCESSES)
    files = spark.createDataFrame([("h", "/srv/r.conf", "# c\nport 666\n")], "host STRING, path STRING, body STRING")
    assert V.server_resources(df, "key-value", files).first().key == "key-value 666"


def test_database_server(spark):
    line = ["/u01/app/timesten/product/11.2.2.6.4/TimesTen/ttstg1/bin/ttcserver", "-p", "53390"]
    df = spark.createDataFrame([("h", 1, "ttcserver", line, "/", {}, None)], schema.PROCESSES)
    out = V.server_resources(df, "database").first()
    assert (out.key, out.version) == ("ttstg1:53390", "11.2.2.6.4")


def test_all_kinds_of_servers_in_one_scan(spark):
    data = [
        ("h", 1, "redis-server", ["redis-server", "--port", "7", "r.conf"], "/srv", {}, None),
        ("h", 2, "redis-server", ["redis-server", "r.conf", "--port", "7"], "/srv", {}, None),
        ("h", 3, "redis-server", ["redis-server", "gone.conf"], "/srv", {}, None),
        ("h", 4, "redis-server", ["redis-server"], None, None, None),
        ("h", 5, "memcached", ["memcached"], "/", {}, None),
        ("h", 5, "memcached", ["memcached"], "/", {}, None),
        ("h", 6, "splunkd", ["splunkd", "start"], "/", {}, None),
        ("h", 7, None, None, None, None, None),
        (None, 8, "mongod", ["mongod"], "/", None, None),
    ]
    df = spark.createDataFrame(data, schema.PROCESSES)
    files = spark.createDataFrame([("h", "/srv/r.conf", "port 666"), ("h", "/srv/r.conf", "port 667"), ("i", "/srv/gone.conf", "port 1")], "host STRING, path STRING, body STRING")
    found = sorted((r.type, r.key, r.parent_key or "") for r in V.server_resources(df, conf_files=files).collect())
    assert found == [
        ("CacheServer", "0.0.0.0:11211", "h"), ("DocumentServer", "localhost:27017", ""),
        ("KeyValueServer", "key-value 6379", "h"), ("KeyValueServer", "key-value 666", "h"), ("KeyValueServer", "key-value 7", "h"),
    ]
    assert sorted(r.key for r in V.server_resources(df).collect() if r.type == "KeyValueServer") == ["key-value 6379", "key-value 7"]
    assert V.server_resources(df.limit(0), conf_files=files).count() == 0
    with pytest.raises(ValueError, match="abacus"):
        V.server_resources(df, "abacus")


def test_one_scan_and_one_exchange_for_all_kinds(spark, tmp_path):
    spark.createDataFrame([("h", 1, "memcached", ["memcached"], "/", {}, None)], schema.PROCESSES).write.parquet(str(tmp_path / "p"))
    plan = V.server_resources(spark.read.parquet(str(tmp_path / "p")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and plan.count("Aggregate") == 1


def test_stated_resources_without_their_setting(spark):
    data = [
        ("h", "directory", {"directory": "/d"}), ("h", "directory", {"directory": "d"}), ("h", "directory", {}), ("h", "directory", None),
        ("h", "checked path", {}), ("h", "trap port", {}), ("h", "configuration client", {"banner": None}),
        ("h", "configuration client", {"banner": "vd 2.1 of today"}), ("h", None, {"port": "1"}), ("h", "unheard of", {"port": "1"}),
        (None, "broker", {"port": "5445"}),
    ]
    df = spark.createDataFrame(data, "host STRING, kind STRING, settings MAP<STRING, STRING>")
    found = sorted((r.type, r.key, r.version or "", r.parent_key or "") for r in V.stated_resources(df).collect())
    assert found == [
        ("Broker", "5445", "", ""), ("CheckedPath", "/", "", "h"), ("ConfigurationClient", "vd", "2.1", "h"), ("Directory", "/d", "", "h"),
    ]
    assert {r.type for r in V.stated_resources(df, ["broker"]).collect()} == {"Broker"}


def test_resource_paths_leave_out_circles(spark):
    data = [("a", None, "A"), ("b", "a", "B"), ("c", "b", "C"), ("d", "c", "D"), ("x", "y", "X"), ("y", "x", "Y"), ("o", "gone", "O"), ("p", "o", "P")]
    df = spark.createDataFrame(data, "key STRING, parent_key STRING, name STRING")
    assert rows(V.resource_paths(df), "key", "path", "depth") == [("a", "A", 1), ("b", "A/B", 2), ("c", "A/B/C", 3), ("d", "A/B/C/D", 4)]


def test_long_chain(spark):
    data = [(str(i), str(i - 1) if i else None, str(i)) for i in range(70)]
    df = spark.createDataFrame(data, "key STRING, parent_key STRING, name STRING")
    found = {r["key"]: r["path"] for r in V.resource_paths(df).collect()}
    assert found["69"] == "/".join(str(i) for i in range(70))


def test_dependency_order(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "a"), ("c", "b"), ("x", "y"), ("y", "x")], "item STRING, needs STRING")
    items = spark.createDataFrame([(i,) for i in "abcxyz"], "item STRING")
    assert rows(V.dependency_order(edges, items), "item", "level") == [("a", 0), ("b", 1), ("c", 2), ("z", 0)]


def test_dependency_order_of_many_needs(spark):
    """Needs met in different rounds, stated twice, of itself, of no item; what a circle blocks stays out."""
    edges = [("t", f"n{i}") for i in range(6)] + [(f"n{i}", f"n{i - 1}") for i in range(1, 6)] + [("t", "n0"), ("u", "t"), ("u", "outside")]
    edges += [("s", "s"), ("v", "s"), ("w", None), (None, "w"), ("ghost", "n0")]
    items = [(f"n{i}",) for i in range(6)] + [("t",), ("u",), ("s",), ("v",), ("w",)]
    found = V.dependency_order(spark.createDataFrame(edges, "item STRING, needs STRING"), spark.createDataFrame(items, "item STRING"))
    expected = [(f"n{i}", i) for i in range(6)] + [("t", 6), ("u", 7), ("w", 0)]
    assert rows(found, "item", "level") == sorted(expected)
    none = spark.createDataFrame([], "item STRING, needs STRING")
    assert V.dependency_order(none, none.select("item")).count() == 0


def test_inventory_diff_and_upsert(spark):
    before = spark.createDataFrame([("k1", "a"), ("k2", "b"), ("k3", None)], "key STRING, v STRING")
    after = spark.createDataFrame([("k2", "c"), ("k3", None), ("k4", "d")], "key STRING, v STRING")
    assert rows(V.inventory_diff(before, after, ["key"], ["v"]), "key", "status") == [("k1", "removed"), ("k2", "changed"), ("k4", "added")]
    assert rows(V.upsert_inventory(before, after, ["key"]), "key", "v") == [("k1", "a"), ("k2", "c"), ("k3", None), ("k4", "d")]


def test_rebind(spark):
    known = spark.createDataFrame([("app", "1"), ("gone", "2")], "name STRING, id STRING")
    now = spark.createDataFrame([("app", "7")], "name STRING, id STRING")
    assert rows(V.rebind(known, now), "name", "id", "up") == [("app", "7", True), ("gone", "2", False)]


def test_a_resource_without_a_parent_is_compared_with_itself(spark):
    ddl = "type STRING, parent_key STRING, key STRING, version STRING"
    before = spark.createDataFrame([("a", None, "1", "x"), ("a", None, "2", "x"), ("a", "p", "1", "x"), ("a", None, None, "x")], ddl)
    after = spark.createDataFrame([("a", None, "1", "x"), ("a", None, "2", "y"), ("a", "q", "1", "x"), ("a", None, None, "x")], ddl)
    found = V.inventory_diff(before, after, ["type", "parent_key", "key"], ["version"])
    assert sorted((r.parent_key or "", r.key, r.status) for r in found.collect()) == [("", "2", "changed"), ("p", "1", "removed"), ("q", "1", "added")]
