"""Readers and writers on files."""

import datetime

from pyspark.sql import functions as F

from fleetspan import schema
from fleetspan.sources import readers as RD
from fleetspan.sources import sinks as SK


def test_bodies_and_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("é one\r\ntwo\n".encode("ISO-8859-1"))
    body = RD.read_bodies(spark, str(tmp_path), "ISO-8859-1").first()
    assert (body.body, body.content_length) == ("é one\r\ntwo\n", 11)
    assert body.last_modified > 0
    found = RD.read_lines(spark, str(tmp_path), "ISO-8859-1").orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in found] == [(0, "é one"), (1, "two")]


def test_log_lines_keep_their_order(spark, tmp_path):
    (tmp_path / "m.log").write_text("".join(f"line {i}\n" for i in range(50)))
    found = RD.read_log(spark, str(tmp_path)).orderBy("file", "block", "seq").collect()
    assert [r.line for r in found] == [f"line {i}" for i in range(50)]


def test_listing_does_not_read_contents(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.bin").write_bytes(b"12345")
    df = RD.list_files(spark, str(tmp_path))
    row = df.first()
    assert row.path.endswith("/d/x.bin") and row.length == 5
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()


DESCRIPTOR = """<plugin><service name="S">
 <metric property="length" dataType="measurement" units="bytes" defaultInterval="3600000" measurementType="trendsup" displayType="summary" defaultOn="true"/>
 <metric property="state" dataType="trait"/><metric property="plain"/>
</service></plugin>"""


def test_definitions(spark, tmp_path):
    (tmp_path / "table.xml").write_text(DESCRIPTOR)
    found = {r.metric: r for r in RD.read_definitions(spark, str(tmp_path)).collect()}
    assert set(found) == {"length", "state", "plain"}
    assert (found["length"].resource_type, found["length"].interval_ms, found["length"].measurement_type) == ("table", 3600000, "trendsup")
    assert (found["state"].data_type, found["plain"].data_type, found["plain"].interval_ms) == ("trait", "measurement", 600000)


def test_json_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": {"b": 1}}')
    (tmp_path / "b.json").write_text("[1]")
    found = RD.read_json_documents(spark, str(tmp_path))
    values = found.select(F.try_variant_get("document", "$.a.b", "int").alias("v")).collect()
    assert sorted(r.v for r in values if r.v is not None) == [1]


def test_tail(spark):
    lines = spark.createDataFrame([("f", 3, 0, "a"), ("f", 3, 1, "b"), ("f", 3, 2, "c"), ("g", 1, 0, "x"), ("h", 1, 0, "y")], "file STRING, length BIGINT, pos BIGINT, line STRING")
    offsets = spark.createDataFrame([("f", 1), ("g", 9)], "file STRING, offset BIGINT")
    assert sorted(r.line for r in RD.tail_lines(lines, offsets).collect()) == ["b", "c", "x", "y"]
    after = RD.next_offsets(lines)
    assert {(r.file, r.offset) for r in after.collect()} == {("f", 3), ("g", 1), ("h", 1)}
    assert RD.tail_lines(lines, after).count() == 0


def test_captured_tables_have_fixed_schemas(spark, tmp_path):
    ts = datetime.datetime(2024, 1, 1)
    run = spark.createDataFrame([("h", "/bin/netstat", "{-s}", 0, "out", 5, ts)], schema.COMMAND_RUNS)
    run.write.parquet(str(tmp_path / "runs"))
    assert RD.read_command_runs(spark, str(tmp_path / "runs")).first().stdout == "out"
    for read, ddl in [(RD.read_responses, schema.RESPONSES), (RD.read_traps, schema.TRAPS), (RD.read_varbinds, schema.VARBINDS), (RD.read_processes, schema.PROCESSES), (RD.read_attributes, schema.ATTRIBUTES)]:
        path = str(tmp_path / read.__name__)
        spark.createDataFrame([], ddl).write.parquet(path)
        assert read(spark, path).count() == 0


def test_report_and_event_sinks(spark, tmp_path):
    ts = datetime.datetime(2024, 1, 1, 12)
    report = spark.createDataFrame([("t", "r", "m", ts, "measurement", 1.0, None), ("t", "r", "n", ts, "trait", None, "x")], "resource_type STRING, resource_key STRING, metric STRING, ts TIMESTAMP, data_type STRING, dvalue DOUBLE, svalue STRING")
    path = str(tmp_path / "report")
    SK.write_report(report, path)
    SK.write_report(report, path)
    back = spark.read.parquet(path)
    assert back.count() == 4
    assert {(r.data_type, str(r.date)) for r in back.collect()} == {("measurement", "2024-01-01"), ("trait", "2024-01-01")}
    events = spark.createDataFrame([("Trap", "h", ts, "INFO", "d")], schema.EVENTS)
    SK.write_events(events, str(tmp_path / "events"))
    assert spark.read.parquet(str(tmp_path / "events")).count() == 1
    inventory = spark.createDataFrame([("t", "k", "n", None, None, {}, None)], schema.INVENTORY)
    SK.write_inventory(inventory, str(tmp_path / "inv"))
    SK.write_inventory(inventory, str(tmp_path / "inv"))
    assert spark.read.parquet(str(tmp_path / "inv")).count() == 1


def test_line_starts_in_files_of_many_splits(spark, tmp_path):
    path = f"{tmp_path}/lines"
    text = [("ä" * (i % 23) + f" line {i}" if i % 7 else "") for i in range(3000)]
    spark.createDataFrame([(x,) for x in text], "value STRING").coalesce(1).write.text(path)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows = RD.read_lines_at(spark, path).orderBy("start").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    at = 0
    for row, want in zip(rows, text, strict=True):
        size = len(want.encode()) + 1
        assert (row.line, row.start, row.end) == (want, at, at + size)
        at += size
    assert rows[0].size == at


def test_tail_goes_on_starts_again_and_follows_a_renamed_file(spark):
    ddl = "file STRING, size BIGINT, line STRING, start BIGINT, end BIGINT"

    def files(contents):
        rows = []
        for name, content in contents.items():
            at = 0
            for line in content.splitlines(keepends=True):
                rows.append((name, len(content.encode()), line.rstrip("\n"), at, at := at + len(line.encode())))
        return spark.createDataFrame(rows, ddl)

    def run(contents, ledger):
        new, ledger = RD.tail_files(files(contents), ledger)
        return sorted((r.file, r.line) for r in new.collect()), spark.createDataFrame(ledger.collect(), RD.LEDGER)

    first, ledger = run({"a": "1\n2\n", "b": "x\ny\n", "c": "p\nq\n", "d": "half of ä l"}, spark.createDataFrame([], RD.LEDGER))
    assert first == [("a", "1"), ("a", "2"), ("b", "x"), ("b", "y"), ("c", "p"), ("c", "q"), ("d", "half of ä l")]
    # a grows, b is cut, c is renamed and begun anew, d's line is finished.
    second, ledger = run({"a": "1\n2\n3\n", "b": "x\n", "c": "new\nlog\n", "c.1": "p\nq\nr\n", "d": "half of ä line\nnext\n"}, ledger)
    assert second == [("a", "3"), ("b", "x"), ("c", "log"), ("c", "new"), ("c.1", "r"), ("d", "ine"), ("d", "next")]
    third, _ = run({"a": "1\n2\n3\n", "b": "x\n", "c": "new\nlog\n", "c.1": "p\nq\nr\n", "d": "half of ä line\nnext\n"}, ledger)
    assert third == []


def test_a_repeated_run_gives_its_rows_once(spark, tmp_path):
    path = str(tmp_path / "report")
    at = datetime.datetime(2024, 1, 1)
    rows = lambda n: spark.createDataFrame([("r", i, "measurement", at) for i in range(n)], "resource_key STRING, value INT, data_type STRING, ts TIMESTAMP")
    SK.write_report(rows(3), path, run="1")
    SK.write_report(rows(5), path, run="2024-01-01")
    SK.write_report(rows(4), path, run="1")  # again, with what it found then
    # An attempt that failed before its commit.
    rows(9).withColumn("date", F.to_date("ts")).write.partitionBy("data_type", "date").parquet(f"{path}/rows/run=r-3/attempt=a-x")
    got = SK.read_runs(spark, path)
    assert {r.run: r["count"] for r in got.groupBy("run").count().collect()} == {"1": 4, "2024-01-01": 5}
    SK.write_events(rows(2), path + "-events", run="7")
    SK.write_events(rows(2), path + "-events", run="7")
    assert SK.read_runs(spark, path + "-events").count() == 2
