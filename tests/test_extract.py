"""Golden values of the extraction and coercion functions."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from fleetspan.functions import address as A
from fleetspan.functions import coerce as C
from fleetspan.functions import extract as X
from fleetspan.functions import html as H
from fleetspan.functions import oid as O
from fleetspan.functions import text as T
from fleetspan.functions import urls as U
from fleetspan.operators import metadata as M
from fleetspan.operators import digest as JD
from fleetspan.operators.digest import digest_errors, json_digest, numeric_digest


def one(spark, column, **values):
    """Value of an expression over one row."""
    row = spark.range(1).select(*[v.alias(k) if hasattr(v, "alias") else F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "pattern, groups",
    [("abc", 0), ("a(b)c", 1), (r"a\(b", 0), ("(?:a)(b)", 1), ("(?<n>a)", 1), ("(?<=a)b", 0), ("(?<!a)b(c)", 1), ("[(](a)", 1), (r"\Q(\E(a)", 1), ("(?s)a", 0)],
)
def test_count_groups(pattern, groups):
    assert X.count_groups(pattern) == groups


@pytest.mark.parametrize(
    "pattern, value",
    [(r"apple: (\d+)", "42"), (r"banana: (\d+)", "49"), (r"\d+", "42"), ("zucchini", None), ("(z)ucchini", None), ("apple:( *)x?", " "), ("(q*)apple", "")],
)
def test_regex(spark, pattern, value):
    assert one(spark, X.extract_regex(F.col("b"), pattern), b="apple: 42  banana: 49") == value


def test_response_metrics(spark):
    row = [("r", 200, {"x-head": ["13", "14"]}, "apple: 42  banana: 49", 150, 21, 7)]
    df = spark.createDataFrame(row, "resource_key STRING, code INT, headers MAP<STRING, ARRAY<STRING>>, body STRING, elapsed_ms BIGINT, content_length BIGINT, last_modified BIGINT")
    wanted = [r"apple: (\d+)", r"banana: (\d+)", "#X-Head", "#none", "responseSize", "responseTime", "lastModified"]
    out = X.extract_metrics(df, wanted, "regex", ["resource_key"])
    found = {r["metric"]: r["n"] for r in out.select("metric", C.to_numeric(F.col("value")).alias("n")).collect()}
    assert found == {wanted[0]: 42.0, wanted[1]: 49.0, "#X-Head": 13.0, "responseSize": 21.0, "responseTime": 150.0, "lastModified": 7.0}
    shown = X.explain_extract(df, "regex", r"apple: (\d+)").first()
    assert (shown.success, shown.response_code, shown.response) == (True, 200, "42")
    assert X.explain_extract(df, "regex").first().response == "apple: 42  banana: 49"


@pytest.mark.parametrize(
    "body, path, value",
    [
        ("<i><t>999</t></i>", "//t/text()", "999"),
        ("<i><t>999</t></i>", "//none", None),
        ("not xml <", "//t", None),
        ("", "//t", None),
        ('<a xmlns="urn:x"><b>1</b></a>', "//*[local-name()='b']", "1"),
    ],
)
def test_xpath(spark, body, path, value):
    assert one(spark, X.extract_xpath(F.col("b"), path), b=body) == value


def test_xpath_metrics_of_mixed_bodies(spark):
    df = spark.createDataFrame([(1, "<a><b>5</b></a>"), (2, "oops")], "id INT, body STRING")
    out = X.extract_metrics(df, ["//b", "//c"], "xml", ["id"])
    assert [tuple(r) for r in out.collect()] == [(1, "//b", "5")]


@pytest.mark.parametrize(
    "path, value",
    [("/body/0", "42"), ("/body/1", "aaa"), ("/body/2/1", "55"), ("|body|2|1", "55"), (".body.2.1", "55"), ("/none", None), ("/body/9", None), ("/body/0/x", None), ("", None), ("/7", "seven")],
)
def test_json_path(spark, path, value):
    assert one(spark, X.json_path(F.col("b"), path), b='{"body":[42,"aaa",[1,55]],"7":"seven"}') == value


@pytest.mark.parametrize("path, value", [("/it's", "1"), ("/*", "2"), ("/a.b/0", "3"), ("/a.b/1/x*", "4"), ("/a]b", "5"), ("/no'pe", None)])
def test_json_path_with_odd_keys(spark, path, value):
    body = '{"it\'s":1,"*":2,"a.b":[3,{"x*":4}],"a]b":5}'
    assert one(spark, X.json_path(F.col("b"), path), b=body) == value


PATHS = {
    "a": "/a", "ab": "/a/b", "upper": "/A", "first": "/l/0", "inner": "/l/1/x", "deep": "/l/1/y/0", "key": "/l/7", "cut": "|l|2|0|z",
    "none": "", "all": "/", "star": "/*", "broken": "/_corrupt_record", "zero": "/0", "dots": "#a.b#0",
}
DOCUMENTS = [
    '{"a":{"b":1},"A":2,"l":[3,{"x":4,"y":[5]},[{"z":6}]],"*":7,"_corrupt_record":8,"0":9,"a.b":[10]}',
    '{"l":{"0":1,"1":{"x":2,"y":{"0":3}},"2":[{"z":4}],"7":5},"a":null,"a.b":{"0":"six"}}',
    '{"a":1,"a":{"b":2},"l":[1],"l":[2,3]}', '{"a":{"b":1},"a":null}', '{"a":"x","l":"y"}', '[{"a":1},2]', '[[1]]', "null", "3", "", " ", None, "{", '{"a":1',
    '{"a":{"b":[1, 2.50]},"l":[null,null]}', ' \n {"a" : {"b" : "t\\u00e9\\n"}}', '{"l":[[],{"x":{}},[[1]]]}', '{"l":[1,"t",[{"z":null}]]}',
]


def by_python(text, path):
    """Value at a path, as text, by the json module."""
    if not path or text is None:
        return None
    steps = path[1:].split(path[0])
    while steps and steps[-1] == "":
        steps.pop()
    try:
        value = json.loads(text)
    except ValueError:
        return None if steps or not text.lstrip().startswith("{") else text
    if not steps:
        return text if isinstance(value, dict) else None
    for step in steps:
        if isinstance(value, dict):
            value = value.get(step)
        elif isinstance(value, list) and step.isdigit():
            value = value[int(step)] if int(step) < len(value) else None
        else:
            return None
    if value is None:
        return None
    return value if isinstance(value, str) else json.dumps(value)


def plain(text):
    """Texts of containers and numbers apart from how they are written."""
    try:
        return json.dumps(json.loads(text))
    except (TypeError, ValueError):
        return text


def test_paths_by_one_parse_and_one_by_one(spark):
    df = spark.createDataFrame(list(enumerate(DOCUMENTS)), "id INT, body STRING")
    together = {r.id: r for r in X.with_paths(df, "body", PATHS).collect()}
    alone = {r.id: r for r in df.select("id", *[X.json_path(F.col("body"), p).alias(n) for n, p in PATHS.items()]).collect()}
    for i, text in enumerate(DOCUMENTS):
        for name, path in PATHS.items():
            assert plain(together[i][name]) == plain(alone[i][name]) == plain(by_python(text, path)), (text, path)


def test_dotted_paths_by_one_parse(spark):
    df = spark.createDataFrame([('{"m":{"r":1,"l":[2]},"m":{"r":3,"l":[4]},"n":{"0":5}}',), ("[1]",), (None,)], "body STRING")
    paths = {"r": "m.r", "l": "m.l.0", "z": "n.0"}
    assert [tuple(r)[1:] for r in X.with_paths(df, "body", paths, "map").collect()] == [("3", None, "5"), (None,) * 3, (None,) * 3]
    assert [tuple(r) for r in df.select(*[X.map_path(F.col("body"), p) for p in paths.values()]).collect()][0] == ("3", None, "5")


def test_a_body_is_parsed_once(spark, tmp_path):
    spark.createDataFrame([("{}",)], "body STRING").write.parquet(str(tmp_path / "b"))
    df = spark.read.parquet(str(tmp_path / "b"))
    names = {"a": "/m/a", "b": "/m/b/c", "c": "/n", "d": "/m/b/d"}
    for out in (
        X.with_paths(df, "body", names), X.with_paths(df, "body", {n: p[1:].replace("/", ".") for n, p in names.items()}, "map"),
        X.with_paths(df, "body", {"a": "s.g.x", "b": "s.g.y", "c": "t.g.x"}, "grouped"),
        X.extract_metrics(df, list(names.values()), X.wrapped("jsonTree", X.low_bits_of_window_ids), []),
    ):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_metrics_by_path(spark):
    body = '{"m":{"currentWindowId":"4295032835","n":1},"x.y":2}'
    df = spark.createDataFrame([(1, body, 7), (2, None, 8)], "id INT, body STRING, elapsed_ms BIGINT").withColumn("headers", F.create_map(F.lit("Date"), F.array(F.lit("d"))))
    read = X.wrapped("jsonTree", X.low_bits_of_window_ids)
    out = X.extract_metrics(df, ["/m/currentWindowId", "/m/n", "/gone", "responseTime", "#date"], read, ["id"])
    assert sorted(map(tuple, out.collect())) == [
        (1, "#date", "d"), (1, "/m/currentWindowId", "3"), (1, "/m/n", "1"), (1, "responseTime", "7"), (2, "#date", "d"), (2, "responseTime", "8"),
    ]
    with pytest.raises(ValueError, match="abacus"):
        X.with_paths(df, "body", {}, "abacus")


def test_json_path_needs_an_object_for_the_whole_document(spark):
    assert one(spark, X.json_path(F.col("b"), "/"), b="[1]") is None


@pytest.mark.parametrize("body, size", [("{}", 0), ('{"foo":{},"bar":{}}', 2), ("x", -1)])
def test_json_size(spark, body, size):
    assert one(spark, X.json_size(F.col("b")), b=body) == size


def digest(spark, body):
    df = spark.createDataFrame([(body,)], "b STRING")
    return {r["key"]: (r["value"], r["number"]) for r in json_digest(df, "b", []).collect()}


def test_digest_at_any_depth(spark):
    deep = '{"a":' * 20_000 + '{"x":5,"y":"z"}' + "}" * 20_000
    assert digest(spark, deep) == {"x": ("5", 5.0), "y": ("z", None)}
    assert digest(spark, '{"l":' + "[" * 20_000 + '{"x":1}' + "]" * 20_000 + "}") == {"x": ("1", 1.0)}


@pytest.mark.parametrize("wrap", ["%s", '{"outer":%s}', "[%s]"])
def test_digest_is_the_same_flat_and_nested(spark, wrap):
    big = "123456789012345678901234567890123456789012345"
    body = '{"n":%s,"k":1,"k":"two","q\\"uote":"a\\\\","u":"\\u00e9\\n{x:1}"}' % big
    found = digest(spark, wrap % body)
    assert found == {"n": (big, float(big)), "k": ("two", None), 'q"uote': ("a\\", None), "u": ("\u00e9\n{x:1}", None)}


@pytest.mark.parametrize("body", ["{'a':1}", '{"a":1} xx', '{"a":1', '{"a":01}', "", "oops", '{"a" 1}', '{"a":1,"b":{}} xx', '{"b":{},"a":tru}', '{"a":"x}'])
def test_broken_documents_are_errors(spark, body):
    df = spark.createDataFrame([(1, body), (2, None)], "id INT, b STRING")
    assert json_digest(df, "b", ["id"]).collect() == []
    assert [tuple(r) for r in digest_errors(df, "b", ["id"]).collect()] == [(1, "no JSON document")]


def test_digest_walks_maps_and_lists(spark):
    assert digest(spark, '{"body":{"title":66}}') == {"title": ("66", 66.0)}
    body = '{"a":{"x":1,"s":"t","e":"","t":true,"n":null},"l":[1,"q",{"y":"2.50"},[{"z":1.50}]]}'
    assert digest(spark, body) == {"x": ("1", 1.0), "s": ("t", None), "y": ("2.50", None), "z": ("1.5", 1.5)}


def test_digest_last_key_in_document_order_wins(spark):
    assert digest(spark, '{"b":{"x":1},"a":{"x":2}}')["x"] == ("2", 2.0)
    assert digest(spark, '{"x":{"x":1},"a":0}') == {"x": ("1", 1.0), "a": ("0", 0.0)}
    assert digest(spark, '{"x":1,"x":2}') == {"x": ("2", 2.0)}
    assert digest(spark, '[{"x":1},{"x":3}]') == {"x": ("3", 3.0)}


def test_digest_flat_and_walked_agree(spark):
    flat = '{"i":5,"big":12345678901,"f":1.50,"e":1e5,"s":"42","b":false,"n":null,"empty":"","u":"\\u00e9\\n"}'
    wrapped = '{"o":' + flat + "}"
    assert digest(spark, flat) == digest(spark, wrapped)
    assert digest(spark, flat)["f"] == ("1.5", 1.5)


def test_digest_of_broken_and_deep_documents(spark):
    assert digest(spark, "{oops") == {}
    assert digest(spark, "") == {}
    deep = '{"a":' * 400 + '{"k":1}' + "}" * 400
    assert digest(spark, deep) == {"k": ("1", 1.0)}


def test_numeric_digest(spark):
    df = spark.createDataFrame([('{"a":"12.5","b":"x","c":true,"d":{"e":7}}',)], "b STRING")
    assert {tuple(r) for r in numeric_digest(df, "b", []).collect()} == {("a", 12.5), ("e", 7.0)}


INSTRUMENTS = '{"samplers":[{"group":"jdbc","data":[{"name":"x","value":1},{"name":"connections.active","value":6.0}]}],"counters":[]}'


@pytest.mark.parametrize(
    "metric, value", [("samplers.jdbc.connections.active", "6.0"), ("samplers.none.x", None), ("timers.a.b", None), ("samplers.jdbc", None)]
)
def test_grouped_value(spark, metric, value):
    assert one(spark, X.grouped_value(F.col("b"), metric), b=INSTRUMENTS) == value
    df = spark.createDataFrame([(INSTRUMENTS,)], "body STRING")
    assert X.with_paths(df, "body", {"v": metric, "w": "samplers.jdbc.x"}, "grouped").first()[1:] == (value, "1")


def test_a_group_without_data_hides_no_other(spark):
    body = '{"s":[{"group":"g"},{"group":"g","data":[null,{"name":"n","value":null}]},{"group":"g","data":[{"name":"m","value":2}]}]}'
    df = spark.createDataFrame([(body,), ('{"s":{"group":"g"}}',), ("[]",)], "body STRING")
    assert [r[1] for r in X.with_paths(df, "body", {"m": "s.g.m"}, "grouped").collect()] == ["2", None, None]


def test_status_document(spark):
    body = '{"globalLock":{"totalTime":2.62192943E8,"lockTime":228.0},"mem":{"resident":4}}'
    assert one(spark, X.map_path(F.col("b"), "mem.resident"), b=body) == "4"
    share = C.ratio(X.map_path(F.col("b"), "globalLock.lockTime").cast("double"), X.map_path(F.col("b"), "globalLock.totalTime").cast("double"))
    assert one(spark, share, b=body) == pytest.approx(8.6959e-7, rel=1e-4)


@pytest.mark.parametrize("text, number", [("1,234.50", 1234.5), (" 7\t", 7.0), ("x", None), ("", None), (None, None)])
def test_to_numeric(spark, text, number):
    assert one(spark, C.to_numeric(F.lit(text).cast("string"))) == number


@pytest.mark.parametrize("low, high, total", [(42, 4, 17179869226), (0, 2**32 - 1, (2**32 - 1) << 32), (-1, 1, None), (1, 2**32, None)])
def test_compose64(spark, low, high, total):
    assert one(spark, C.compose64(F.lit(low).cast("bigint"), F.lit(high).cast("bigint"))) == total


def test_codes(spark):
    codes = F.create_map(F.lit(1), F.lit("enabled"), F.lit(2), F.lit("disabled"))
    assert [one(spark, C.decode_code(F.lit(n), codes)) for n in (1, 2, 3)] == ["enabled", "disabled", "3"]


@pytest.mark.parametrize(
    "kind, raw, wanted, codes, number, text",
    [
        ("Integer32", "2", "measurement", {2: "moderate"}, None, "moderate"),
        ("Integer32", "9", "measurement", {2: "moderate"}, None, "9"),
        ("Integer32", "7", "measurement", None, 7.0, None),
        ("OctetString", "1.5", "measurement", None, 1.5, None),
        ("OctetString", "v1", "trait", None, None, "v1"),
        ("TimeTicks", "123", "measurement", None, 1230.0, None),
    ],
)
def test_snmp_value(spark, kind, raw, wanted, codes, number, text):
    mapping = F.lit(None).cast("map<int, string>") if codes is None else F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    value = one(spark, C.snmp_value(F.lit(kind), F.lit(raw), F.lit(wanted), mapping))
    assert (value["dvalue"], value["svalue"]) == (number, text)


def test_dates(spark):
    parsed = C.parse_http_date(F.col("d"))
    assert one(spark, C.iso_minute(parsed), d="Tue, 4 Jun 2013 17:05:09 GMT") == "2013-06-04T17:05+0000"
    assert one(spark, parsed, d="Tue, 4 Jun 2013 17:05:09 GMT") == datetime.datetime(2013, 6, 4, 17, 5, 9)
    assert one(spark, parsed, d="soon") is None


def test_bytes(spark):
    assert bytes(one(spark, C.hex_bytes(F.col("h")), h="0x6869")) == b"hi"
    assert one(spark, C.octets_text(F.encode(F.lit("é–"), "UTF-8"))) == "é–"


@pytest.mark.parametrize(
    "path, fixed",
    [
        ("hdfs://h/data/x/t/period=daily/dt=2011-07-14/part=r", "/data/x/t"),
        ("hdfs://h/data/x/t/period=daily and not so daily", "/data/x/t"),
        ("/data/x/log/2011-11-04/201111040900", "/data/x/log"),
        ("/data/x/s/dt=$%7BDATE1}", "/data/x/s"),
        ("/data/a+b/c%20d", "/data/a+b/c d"),
    ],
)
def test_table_path(spark, path, fixed):
    assert one(spark, U.table_path(F.col("p")), p=path) == fixed


@pytest.mark.parametrize(
    "url, parent, resolved",
    [
        ("/a/b", "http://h:1/x/y?q", "http://h:1/a/b"),
        ("b", "http://h:1/x/y?q", "http://h:1/x/b"),
        ("b", "http://h:1", "http://h:1/b"),
        ("https://o/", "http://h:1/x", "https://o/"),
        ("//o/p", "https://h/x", "https://o/p"),
        ("http://HOST:8/x", "http://h", "http://me:8/x"),
    ],
)
def test_resolve_url(spark, url, parent, resolved):
    assert one(spark, U.resolve_url(F.col("u"), F.col("p"), "HOST", F.lit("me")), u=url, p=parent) == resolved


def argv(*args):
    return F.array(*[F.lit(a) for a in args]) if args else F.array().cast("array<string>")


@pytest.mark.parametrize(
    "args, url",
    [
        (("-Doozie.http.hostname=hosty", "-Doozie.http.port=11004"), "http://hosty:11004/oozie"),
        ((), "http://localhost:11000/oozie"),
        (("-Doozie.base.url=http://example.net",), "http://example.net"),
    ],
)
def test_workflow_url(spark, args, url):
    assert one(spark, A.workflow_url(argv(*args))) == url


@pytest.mark.parametrize(
    "args, host, port", [(("-l", "127.0.0.1:9999"), "127.0.0.1", 9999), (("-p", "7777"), "0.0.0.0", 7777), ((), "0.0.0.0", 11211), (("-l", "10.0.0.1"), "10.0.0.1", 11211)]
)
def test_cache_address(spark, args, host, port):
    found = one(spark, A.cache_address(argv(*args)))
    assert (found["host"], found["port"]) == (host, port)


@pytest.mark.parametrize(
    "args, body, port",
    [
        (("redis-server",), None, 6379),
        (("redis-server", "--port", "7"), "port 666", 7),
        (("redis-server", "/c", "--port", "7"), "port 666", 7),
        (("redis-server", "--port", "7", "/c"), "# x\nport 666\n", 666),
        (("redis-server", "/c"), "other 1", 6379),
        (("redis-server", "/c"), "port 666", 666),
    ],
)
def test_key_store_port(spark, args, body, port):
    assert one(spark, A.key_store_port(argv(*args), F.lit(body).cast("string"))) == port


def test_key_store_conf(spark):
    assert one(spark, A.key_store_conf(argv("redis-server", "--port", "7", "r.conf"), F.lit("/srv"))) == "/srv/r.conf"
    assert one(spark, A.key_store_conf(argv("redis-server", "--port", "7"), F.lit("/srv"))) is None


def test_document_server_address(spark):
    found = one(spark, A.document_server_address(argv("mongod", "--bind_ip", "1.2.3.4,5.6.7.8", "--port", "9")))
    assert (found["host"], found["port"]) == ("1.2.3.4", 9)
    found = one(spark, A.document_server_address(argv("mongod")))
    assert (found["host"], found["port"]) == ("localhost", 27017)


def test_database_identity(spark):
    found = one(spark, A.database_identity(argv("/u01/app/product/11.2.2.6.4/TimesTen/ttstg1/bin/ttcserver", "-verbose", "-p", "53390")))
    assert tuple(found) == ("ttstg1", 53390, "11.2.2.6.4")


@pytest.mark.parametrize(
    "text, version",
    [("/x/hadoop-core-0.20.2+737.jar", "0.20.2+737"), ("/x/hbase-0.90.6-cdh3u4.jar", "0.90.6-cdh3u4"), ("none", None)],
)
def test_jar_versions(spark, text, version):
    assert one(spark, A.version_of_arguments(argv("java", text), A.SERVER_JARS)) == version


def test_device_version(spark):
    assert one(spark, A.version_of(F.lit("NetScaler NS9.2: Build 48.6.nc"), [A.DEVICE_VERSION])) == "9.2"


@pytest.mark.parametrize("address, host, port", [("h:81", "h", 81), ("81", "localhost", 81), ("x", "localhost", None)])
def test_parse_address(spark, address, host, port):
    found = one(spark, A.parse_address(F.col("a")), a=address)
    assert (found["host"], found["port"]) == (host, port)


def test_harvest(spark):
    df = spark.createDataFrame([("connect.to = 8080\nnothing\nport 9x\n",)], "b STRING")
    assert [r["address"] for r in A.harvest(df, "b", []).collect()] == ["8080"]


@pytest.mark.parametrize("body, lines", [("a\nb\n", ["a", "b"]), ("a\r\nb\rc", ["a", "b", "c"]), ("\n", [""]), ("a\n\n", ["a", ""]), ("", None)])
def test_body_lines(spark, body, lines):
    assert one(spark, T.body_lines(F.col("b")), b=body) == lines


LOG = """01-01 INFO Metrics - group=pipeline, name=x, processor=y, cpu_seconds=0.0
01-01 INFO Metrics - group=queue, name=tcpout_ssl_group, max_size_kb=500, current_size=41
01-01 INFO Metrics - group=queue, name=tcpout_ssl_group, max_size_kb=500, current_size=42
01-01 INFO StatusMgr - eventType=connect, x
01-01 INFO Metrics - group=thruput, name=thruput, total_k_processed=13976121
01-01 INFO Metrics - group=queue, name=parsingqueue, current_size_kb=2.1
01-01 INFO StatusMgr - eventType=close
noise
"""


@pytest.mark.parametrize("compat, parsing", [(False, 2.1), (True, 2.0)])
def test_log_metrics(spark, compat, parsing):
    from fleetspan.operators.report import last_wins

    df = T.lines(spark.createDataFrame([(LOG,)], "b STRING"), "b")
    found = last_wins(T.log_metrics(df, "line", ["line_no"], compat), ["metric"], ["line_no", "pair_no"], ["value"])
    values = {r["metric"]: r["value"] for r in found.collect()}
    assert {m: values.get(m) for m in T.LOG_METRICS} == {
        "queue.tcpout_ssl_group.current_size": 42.0,
        "thruput.thruput.total_k_processed": 13976121.0,
        "queue.parsingqueue.current_size_kb": parsing,
        "thruput.index_thruput.total_k_processed": None,
    }
    assert df.filter(T.is_log_event(F.col("line"))).count() == 2


NETSTAT = "Ip:\n    3 total\nTcp:\n    393961 failed connection attempts\n    1991191017 segments received\n    3185535207 segments send out\n    850858195 segments retransmited\n    14 bad segments received.\nUdp:\n"


@pytest.mark.parametrize(
    "name, value",
    [("TCP segments received", "1991191017"), ("TCP segments send out", "3185535207"), ("TCP segments retransmitted", "850858195"), ("TCP bad segments", "14")],
)
def test_netstat(spark, name, value):
    args, pattern = T.NETSTAT_METRICS[name].split("|", 1)
    assert args == "{-s}"
    assert one(spark, X.extract_regex(F.col("b"), pattern), b=NETSTAT) == value


def test_uptime(spark):
    out = " 10:00:00 up 12 days,  3:04,  2 users,  load average: 0.15, 0.10, 0.05"
    found = [one(spark, X.extract_regex(F.col("b"), m.split("|", 1)[1]), b=out) for m in T.UPTIME_METRICS.values()]
    assert found == ["12", "2", "0.15"]


def test_leading_integers(spark):
    assert one(spark, T.leading_integer_sum(F.col("b")), b="12\t/a\nx 5\n30 /b") == 42
    assert one(spark, T.leading_integer_sum(F.col("b")), b="none") is None


def test_stat_dialects(spark):
    stat = spark.createDataFrame([("STAT a 1\r\nSTAT b x.y\r\nEND\r\nSTAT c 2\r\n",)], "b STRING")
    assert [(r["key"], r["value"]) for r in T.parse_stats(stat, "b", "stat", []).collect()] == [("a", "1"), ("b", "x.y")]
    info = spark.createDataFrame([("# Server\r\nredis_version:2.4\r\nused = 7\r\n\r\n",)], "b STRING")
    assert [(r["key"], r["value"]) for r in T.parse_stats(info, "b", "info", []).collect()] == [("redis_version", "2.4"), ("used", "7")]


def test_queue_page(spark):
    bar = '<table border="1px"><tr><td width="57%"></td><td width="43%"></td></tr></table>'
    head = "<table class=x>\n<thead><tr><th>Jobid</th><th>Map Total</th></tr></thead><tbody>"
    rows = "".join(
        f'<tr><td id="job_{i}"><a href="x?{i}">{i}</a></td><td>NORMAL</td><td>u\n{i}</td><td>57.69%{bar}</td>'
        f"<td>{30 + i}</td><td> {i}\n</td><td>0.00%{bar}</td><td>1</td><TD>{i % 2}</TD><td>NA</td></tr>\n"
        for i in range(22)
    )
    page = f"<html>{head}{rows}<tr><td>1</td><td>2</td></tr><tr><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td></tr></tbody></table></html>"
    df = spark.createDataFrame([("q", page), ("q", page), ("none", "<p>")], "queue STRING, html STRING")
    found = {r["queue"]: tuple(r)[1:] for r in H.queue_stats(df, "html", ["queue"]).collect()}
    once = (sum(30 + i for i in range(22)), sum(range(22)), 22, 11, 22)
    assert found == {"q": tuple(2 * n for n in once), "none": (0, 0, 0, 0, 0)}


def test_row_sums_of_open_and_layout_tables(spark):
    unclosed = "<table><tr><td>1<td>2<tr><td>3<td>4</table>"
    assert tuple(one(spark, H.row_sums(F.col("b"), 2), b=unclosed)) == ([4, 6], 2)
    layout = "<table><tr><td><table><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table></td></tr></table>"
    assert tuple(one(spark, H.row_sums(F.col("b"), 3), b=layout)) == ([1, 2, 3], 1)


def test_header_values_and_totals(spark):
    page = '<table border="1">\n<tr><th>Maps</th><th>Idle</th></tr>\n<tr><td>4</td><td></td></tr>\n</table>'
    assert [tuple(p) for p in one(spark, H.header_values(F.col("b")), b=page)] == [("Maps", 4.0)]
    assert one(spark, H.header_values(F.col("b")), b="<p>") is None
    line = "<tr><td>Total: </td><td>servers: 12</td><td>requests=340, regions=96</td></tr>"
    assert tuple(one(spark, H.server_totals(F.col("b")), b=line)) == (12.0, 340.0, 96.0, 8.0)
    assert one(spark, H.server_totals(F.col("b")), b="Total servers: 0, requests=1, regions=2")["rserver"] is None


def test_queue_links(spark):
    page = '<a href="jobqueue_details.jsp?queueName=a">a</a> <a href="jobqueue_details.jsp?queueName=b c">b</a>'
    df = spark.createDataFrame([(page,), (page,)], "html STRING")
    assert {r["link"] for r in H.harvest_links(df, "html").collect()} == {"a", "b c"}


@pytest.mark.parametrize(
    "text, unit",
    [("number of Bytes sent", "bytes"), ("number of KB sent", "kilobytes"), ("number of Mbytes sent", "megabytes"), ("size in MB", "megabytes"), ("number of SECONDS since", "seconds"), ("number of milliSECONDS since", "milliseconds"), ("packets", None)],
)
def test_units(spark, text, unit):
    assert one(spark, M.units(F.col("t")), t=text) == unit


@pytest.mark.parametrize("text, trait", [("The state of this client.", True), ("The Version of this client.", True), ("The number of bytes read.", False)])
def test_trait_words(spark, text, trait):
    assert one(spark, M.reads_as_trait(F.col("t")), t=text) is trait


def test_infer_definition(spark):
    rows = [("total packets", "Integer32", False), ("time since boot", "TimeTicks", False), ("total since last reset", "Counter32", False), ("admin status", "Integer32", False), ("number of ports", "Integer32", True), ("name", "OctetString", False)]
    df = spark.createDataFrame(rows, "descr STRING, syntax STRING, coded BOOLEAN")
    out = M.infer_definition(df, has_codes=F.col("coded")).collect()
    assert [(r.data_type, r.measurement_type, r.units) for r in out] == [
        ("measurement", "trendsup", None), ("measurement", None, "milliseconds"), ("measurement", None, None),
        ("trait", None, None), ("trait", None, None), ("trait", None, None),
    ]


def test_index_decode(spark):
    raw = "11.118.103.54.45.105.97.100.49.45.97.100"
    assert one(spark, O.decode_index(O.oid_array(F.col("i")), [("name", "string")]), i=raw) == {"name": "vg6-iad1-ad"}
    mixed = "2.104.105.7.10.0.0.1.5.6"
    kinds = [("s", "string"), ("n", "int"), ("a", "ip"), ("r", "other")]
    assert one(spark, O.decode_index(O.oid_array(F.col("i")), kinds), i=mixed) == {"s": "hi", "n": "7", "a": "10.0.0.1", "r": "5.6"}
    assert one(spark, O.index_name(O.oid_array(F.col("i")), kinds[:2]), i=mixed) == "s=hi, n=7"
    assert one(spark, O.decode_index(O.oid_array(F.col("i")), kinds), i="9.104") == {"s": "h", "n": None, "a": None, "r": None}


@pytest.mark.parametrize("ticks, text", [(0, "0:00:00.00"), (123, "0:00:01.23"), (8640000 + 360000, "1 day, 1:00:00.00"), (3 * 8640000, "3 days, 0:00:00.00")])
def test_ticks(spark, ticks, text):
    assert one(spark, O.ticks_text(F.lit(ticks).cast("bigint"))) == text


def test_renames(spark):
    df = spark.createDataFrame([("CorruptBlocks", 2.0), ("FilesCreated", 3.0), ("other", 1.0)], "metric STRING, value DOUBLE")
    named = df.select(C.renamed_metric(F.col("metric"), C.ACTIVITY_RENAMES).alias("m"), "value").filter("m is not null")
    assert {tuple(r) for r in named.collect()} == {("BlocksCorrupted", 2.0), ("FilesCreated", 3.0)}
    bytes_of = C.rescaled_value(F.lit("CapacityUsedGB"), F.lit(2.0), C.STORAGE_RENAMES)
    assert one(spark, bytes_of) == 2.0 * 1024**3


def test_source_port_line(spark):
    df = spark.createDataFrame([("agent.sources.s1.port = 4141\nagent.sinks.k.port = 5\n",)], "b STRING")
    assert [r["address"] for r in A.harvest(df, "b", [], A.SOURCE_PORT_LINE).collect()] == ["4141"]


def test_bad_bytes_do_not_fail(spark):
    bad = F.unhex(F.lit("C3A941FF"))
    assert one(spark, C.octets_text(bad)) == "éA\ufffd"
    assert one(spark, C.octets_text(bad, "ascii")) == "\ufffd\ufffdA\ufffd"
    assert one(spark, C.octets_text(bad, "ISO-8859-1")) == "Ã©Aÿ"
    assert one(spark, C.octets_text(F.unhex(F.lit("D800")), "UTF-16BE")) == "\ufffd"


def test_numbers_too_long_give_nothing(spark):
    digits = "9" * 30
    assert one(spark, T.leading_integer_sum(F.col("b")), b=f"{digits} /a") is None
    assert one(spark, H.row_sums(F.col("b"), 1), b=f"<table><tr><td>{digits}</td></tr></table>")["sums"] == [None]
    assert one(spark, X.window_id(F.col("b")), b=digits) is None
    assert one(spark, C.typed_int(F.col("b"), 4), b=digits) == 4
    assert one(spark, O.decode_index(O.oid_array(F.col("b")), [("n", "int")]), b=digits) == {"n": None}


def _levels(n, inside="1"):
    return '{"a":' * n + inside + "}" * n


WHOLE = [
    "{}", "[]", ' [1, 2,{"b":[]}] ', '{"x":" "}', _levels(5000), "[" * 20_000 + "]" * 20_000, '{"a":"' + 'x\\"' * 50_000 + '"}',
    "[" + ",".join('{"a":[%d]}' % i for i in range(2000)) + "]", _levels(60), _levels(61), _levels(121, "[1]"), '{"n":-1.5e+3,"t":true,"z":null}',
]
BROKEN = [
    "", "x", "1", '"a"', '{"a":1} x', '{"a":1},{"b":2}', '{"a":1}],[', '{"a":1},"x":2', '{"a":1}}', "[1", '{"a" 1}', "{a:1}", "[1,]", "[,1]", '{"a":1,}',
    '{"a":}', '{"a":oops}', "[1 2]", '{"a":"b', '{"a":1]', "{" + ",".join('"k%d":[%d]' % (i, i) for i in range(1000)) + ",b:oops}",
    "[" + ",".join("{%d}" % i for i in range(1000)) + "]", '{"a" 1}' * 1000, _levels(1500, "oops"), _levels(1500) + "}", _levels(1500)[:-1],
    _levels(1500, "[1,]"), "[" * 1500 + "}" * 1500, "[01]",
]


def test_broken_documents_of_any_size_are_errors(spark):
    df = spark.createDataFrame([*enumerate([*WHOLE, *BROKEN])], "i INT, body STRING")
    errors = {r.i for r in digest_errors(df, "body", ["i"]).collect()}
    assert errors == {*range(len(WHOLE), len(WHOLE) + len(BROKEN))}
    assert not errors & {r.i for r in json_digest(df, "body", ["i"]).collect()}
    by_grammar = df.select("i", JD.grammatical(JD._tokens(F.col("body"))).alias("ok"))
    assert {r.i for r in by_grammar.collect() if not r.ok} == errors
    assert [(r.key, r.value) for r in json_digest(df.filter("i = 3"), "body", ["i"]).collect()] == [("x", " ")]


def test_header_values_of_a_page_with_very_long_runs_of_tags(spark):
    run = "<b><i class='x'> </i></b>" * 50_000
    page = f"<table border=1> <tr><th>{run}alpha{run}</th><th>beta</th></tr> <tr><td>{run}1</td><td>2{run}</td></tr> </table>"
    plain = "<table border=1> <tr><th>alpha</th><th>beta</th></tr> <tr><td>1</td><td>2</td></tr> </table>"
    df = spark.createDataFrame([(plain,), (page,)], "html STRING")
    found = [[(p.key, p.value) for p in r.v] for r in df.select(H.header_values(F.col("html")).alias("v")).collect()]
    assert found == [[("alpha", 1.0), ("beta", 2.0)]] * 2
