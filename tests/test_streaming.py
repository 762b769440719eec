"""Streams over several micro-batches against the batch operators."""

import datetime

import pytest
from pyspark.sql import functions as F

from fleetspan import schema
from fleetspan.operators import config as CF
from fleetspan.operators import counters as CT
from fleetspan.operators import events as EV
from fleetspan.operators import versions as VS
from fleetspan.operators.skew import HotKeyPolicy
from fleetspan.session import scratch_path
from fleetspan.streaming import jobs as S

CUT = HotKeyPolicy(min_rows=15, skip_below_bytes=0)
START = datetime.datetime(2024, 1, 1)


def as_files(spark, df, label, order, batches=4):
    """Write a table as that many files whose names and times follow the order."""
    path = scratch_path(spark, label)
    rows = df.orderBy(order).collect()
    size = -(-len(rows) // batches)
    for n in range(batches):
        part = rows[n * size : (n + 1) * size]
        spark.createDataFrame(part, df.schema).coalesce(1).write.parquet(f"{path}/part{n}")
    return path + "/part*"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def runs(spark):
    data = [("hot" if i % 3 else f"k{i % 7}", START + datetime.timedelta(seconds=i), i, (i * 7 % 5) % 4, i % 9, i % 4) for i in range(160)]
    return spark.createDataFrame(data, "k STRING, ts TIMESTAMP, id BIGINT, code INT, hits BIGINT, misses BIGINT")


def stream(spark, df, label):
    path = as_files(spark, df, label, "ts")
    return S.read_stream(spark, path, df.schema, files_per_batch=1), S.Place(scratch_path(spark, label))


@pytest.mark.parametrize("policy", [CUT, HotKeyPolicy()])
def test_state_changes_over_batches(spark, runs, policy):
    source, place = stream(spark, runs, "changes")
    S.run_with_state(source, place, ["k"], "k STRING, last_code INT", S.change_step(["k"], ["ts", "id"], "code", policy), merge_every=2).awaitTermination()
    batch = EV.exit_events(runs, ["k"], ["ts", "id"], "code")
    assert rows(S.results(spark, place), "k", "id", "code", "previous", "severity") == rows(batch, "k", "id", "code", "previous", "severity")


def test_rows_out_of_order_and_late(spark):
    """Times 1, 5 | 3, 6 | 20 | 2 with codes 0, 2 | 1, 2 | 0 | 1: 3 waits for its turn, 2 comes too late."""
    at = lambda n: START + datetime.timedelta(seconds=n)
    batches = [[(1, 0), (5, 2)], [(3, 1), (6, 2)], [(20, 0)], [(2, 1)]]
    schema_ = "k STRING, ts TIMESTAMP, id BIGINT, code INT"
    path = scratch_path(spark, "disorder")
    for n, batch in enumerate(batches):
        spark.createDataFrame([("a", at(t), t, c) for t, c in batch], schema_).coalesce(1).write.parquet(f"{path}/part{n}")
    place = S.Place(scratch_path(spark, "disorder"))
    job = S.Stateful(["k"], "k STRING, last_code INT", S.change_step(["k"], ["ts", "id"], "code"), "ts", 5)
    for every in (2, 3):  # another rhythm in a second run does no harm
        source = S.read_stream(spark, path + "/part*", schema_, files_per_batch=1)
        S.run_with_state(source, place, ["k"], job.state_ddl, job.step, merge_every=every, ts="ts", delay_seconds=5).awaitTermination()
    S.drain(spark, place, spark.createDataFrame([], schema_).schema, job)
    on_time = spark.createDataFrame([("a", at(t), t, c) for batch in batches[:3] for t, c in batch], schema_)
    want = EV.exit_events(on_time, ["k"], ["ts", "id"], "code")
    assert rows(S.results(spark, place), "id", "code", "previous") == rows(want, "id", "code", "previous") == [(20, 0, 2), (3, 1, 0), (5, 2, 1)]
    assert [r.id for r in S.late_rows(spark, place, on_time.schema).collect()] == [2]


def test_counter_ratio_over_batches(spark, runs):
    source, place = stream(spark, runs, "ratio")
    state = "k STRING, last_ts TIMESTAMP, last_hits BIGINT, last_misses BIGINT"
    S.run_with_state(source, place, ["k"], state, S.ratio_step(["k"], "ts", "hits", "misses", CUT)).awaitTermination()
    batch = CT.delta_ratio(runs, ["k"], "ts", "hits", "misses")
    assert rows(S.results(spark, place), "k", "ts", "ratio") == rows(batch, "k", "ts", "ratio")


def test_last_value_over_batches_and_restart(spark, runs):
    df = runs.select("k", "id", "code")
    path = as_files(spark, df, "last", "id")
    place = S.Place(scratch_path(spark, "last"))
    for _ in range(2):
        # The second run finds nothing new and changes nothing.
        source = S.read_stream(spark, path, df.schema, files_per_batch=2)
        S.run_with_state(source, place, ["k"], "k STRING, id BIGINT, code INT", S.last_value_step(["k"], ["id"], "code")).awaitTermination()
    newest = S.read_state(spark, place, 2, ["k"], "k STRING, id BIGINT, code INT", 16)
    assert rows(newest, "k", "id", "code") == rows(df.groupBy("k").agg(F.max("id").alias("id"), F.max_by("code", "id").alias("code")), "k", "id", "code")


@pytest.mark.parametrize("merge_every", [1, 2, 3, 16])
def test_state_is_the_same_however_often_it_is_merged(spark, runs, merge_every):
    df = runs.select("k", "id", "code")
    place = S.Place(scratch_path(spark, "merge"))
    ddl = "k STRING, id BIGINT, code INT"
    source = S.read_stream(spark, as_files(spark, df, "merge", "id", 7), df.schema, files_per_batch=1)
    step = S.last_value_step(["k"], ["id"], "code")
    S.run_with_state(source, place, ["k"], ddl, step, merge_every=merge_every).awaitTermination()
    newest = S.read_state(spark, place, 7, ["k"], ddl, merge_every)
    assert rows(newest, "k", "id", "code") == rows(df.groupBy("k").agg(F.max("id").alias("id"), F.max_by("code", "id").alias("code")), "k", "id", "code")


def test_config_changes_over_batches(spark, runs):
    df = runs.select("k", "ts", F.concat(F.lit("c"), (F.col("id") / 40).cast("int").cast("string")).alias("content"))
    source, place = stream(spark, df, "config")
    S.run_with_state(source, place, ["k"], "k STRING, last_hash STRING", S.config_step("k", ["ts"], F.col("content"), CUT)).awaitTermination()
    assert rows(S.results(spark, place), "k", "ts", "changed") == rows(CF.config_changes(df, ["k"], ["ts"], F.col("content")), "k", "ts", "changed")


def test_counts_over_batches(spark, runs):
    source, place = stream(spark, runs, "counts")
    S.run_counts(source.select("k"), place, ["k"]).awaitTermination()
    assert rows(S.latest_counts(spark, place, ["k"]), "k", "n") == rows(runs.groupBy("k").agg(F.count("*").alias("n")), "k", "n")


def test_traps_over_batches(spark):
    data = [
        (i, START + datetime.timedelta(seconds=i), 2, True, "h", None, None, None, None, None, "1.5.6", [("1.9.1.0", "OctetString", f"v{i}")])
        for i in range(12)
    ]
    df = spark.createDataFrame(data, schema.TRAPS)
    mib = spark.createDataFrame([("alert", "1.9.1", "x", True, None, None, None, None, None)], schema.MIB)
    rules = [EV.Rule("WARN", trap_oid="1.5", varbind="1.9.1", value="v1")]
    source, place = stream(spark, df, "traps")
    S.run_stateless(source, place, lambda batch: EV.decode_traps(batch, mib, rules)).awaitTermination()
    batch = EV.decode_traps(df, mib, rules)
    assert rows(S.results(spark, place), "trap_id", "severity", "detail") == rows(batch, "trap_id", "severity", "detail")
    assert rows(batch, "severity").count(("WARN",)) == 3


def test_config_is_read_again_for_every_batch(spark, runs):
    source, place = stream(spark, runs.select("k", "ts", "id"), "refresh")
    reads = []

    def read_config():
        reads.append(1)
        return spark.createDataFrame([("hot", len(reads))], "k STRING, version INT")

    S.with_refreshed_config(source, place, read_config, lambda r, c: r.join(c, "k", "left")).awaitTermination()
    assert len(reads) == 4
    assert {r["version"] for r in S.results(spark, place).filter("k = 'hot'").collect()} == {1, 2, 3, 4}


def replay(spark, batches, ddl, job):
    """A batch of rows after the other through a job with state, then what still waits."""
    path, place = scratch_path(spark, "replay"), S.Place(scratch_path(spark, "replay"))
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, ddl).write.parquet(f"{path}/part{n}")
        S.run_job(S.read_stream(spark, path + "/part*", ddl), place, job).awaitTermination()
    if job.ts:
        S.drain(spark, place, spark.createDataFrame([], ddl).schema, job)
    return S.results(spark, place), S.read_state(spark, place, len(batches) + bool(job.ts), job.keys, job.state_ddl, job.merge_every)


def test_null_keys_null_times_and_gaps(spark):
    at = lambda n: START + datetime.timedelta(hours=n)
    ddl = "k STRING, ts TIMESTAMP, id BIGINT, code INT"
    batches = [[(None, None, 1, 2), (None, at(0), 2, 1), ("a", at(1), 3, 2)], [], [(None, at(500), 4, 1), ("a", at(501), 5, 2)], [(None, at(502), 6, 0), ("b", at(502), 7, 0)]]
    job = S.Stateful(["k"], "k STRING, last_code INT", S.change_step(["k"], ["ts", "id"], "code"), "ts", 60, merge_every=2, buckets=3)
    found, state = replay(spark, batches, ddl, job)
    whole = spark.createDataFrame([r for b in batches for r in b], ddl)
    want = EV.exit_events(whole, ["k"], ["ts", "id"], "code")
    assert rows(found, "k", "id", "code", "previous") == rows(want, "k", "id", "code", "previous")
    assert rows(state, "k", "last_code") == [("a", 2), ("b", 0), (None, 0)]


def test_null_contents_and_counters_over_batches(spark):
    ddl = "k STRING, ts TIMESTAMP, content STRING, hits BIGINT, misses BIGINT"
    at = lambda n: START + datetime.timedelta(seconds=n)
    data = [(k, at(i), c, h, m) for k in ("a", None) for i, (c, h, m) in enumerate([("a", 1, 1), (None, None, 2), ("a", 5, 4), (None, 7, 4), (None, 8, 9)])]
    whole = spark.createDataFrame(data, ddl)
    batches = [[r for r in data if r[1] == at(i)] for i in range(5)]
    for sizes in ([2, 3], [5]):
        parts = [sum(batches[sum(sizes[:i]) : sum(sizes[: i + 1])], []) for i in range(len(sizes))]
        found, _ = replay(spark, parts, ddl, S.Stateful(["k"], "k STRING, last_hash STRING", S.config_step("k", ["ts"], F.col("content"))))
        assert rows(found, "k", "ts", "changed") == rows(CF.config_changes(whole, ["k"], ["ts"], F.col("content")), "k", "ts", "changed")
        state = "k STRING, last_ts TIMESTAMP, last_hits BIGINT, last_misses BIGINT"
        found, _ = replay(spark, parts, ddl, S.Stateful(["k"], state, S.ratio_step(["k"], "ts", "hits", "misses")))
        assert rows(found, "k", "ts", "ratio") == rows(CT.delta_ratio(whole, ["k"], "ts", "hits", "misses"), "k", "ts", "ratio")


def test_a_batch_reads_the_buckets_of_its_keys_only(spark):
    job = S.Stateful(["k"], "k BIGINT, id BIGINT, code INT", S.last_value_step(["k"], ["id"], "code"), buckets=16)
    place = S.Place(scratch_path(spark, "buckets"))
    S._write_state(spark.range(500).selectExpr("id as k", "id", "1 as code"), place.delta(0, 16), ["k"], 16)
    one = spark.createDataFrame([(7,)], "k BIGINT")
    bucket = one.select(S._bucket(["k"], 16)).first()[0]
    state = S.read_state(spark, place, 1, job.keys, job.state_ddl, 16, one, [bucket])
    assert [tuple(r) for r in state.collect()] == [(7, 7, 1)]
    assert len({f for f in state.inputFiles() if "_bucket=" in f}) >= 1
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def document(timeout, **services):
    own = ",".join(f'"{k}":{{"level":["{v}"]}}' for k, v in services.items())
    return f'{{"box":{{"fleet":{{"monitor":{{"timeout":["{timeout}"],"service":{{{own}}}}}}}}}}}'


@pytest.mark.parametrize("sizes", [[2, 2, 3], [7]])
def test_refreshes_rebuild_the_inventory(spark, sizes):
    bodies = [document(1, a=1, b=1), document(1, a=1, b=2), None, document(2, a=1, b=2), "{}", "{broken", document(2, b=2)]
    want = [
        (False, [("a", "added"), ("b", "added")]), (True, [("b", "changed")]), (False, []), (True, [("a", "changed"), ("b", "changed")]),
        (True, [("a", "removed"), ("b", "removed")]), (True, []), (True, [("b", "added")]),
    ]
    data = [(h, i, b) for h in ("x", None) for i, b in enumerate(bodies)]
    job = S.children_job("host", "STRING", ["n"], F.col("body"), CF.service_hashes(F.col("body"), "fleet"), merge_every=2, buckets=2)
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    parts = [[r for r in data if end - size <= r[1] < end] for end, size in zip(ends, sizes, strict=True)]
    found, state = replay(spark, parts, "host STRING, n INT, body STRING", job)
    told = {(r.host, r.n): (r.changed, sorted((c.child, c.status) for c in r.changes)) for r in found.collect()}
    assert told == {(h, i): w for h in ("x", None) for i, w in enumerate(want)}
    built = rows(state.filter("child is not null"), "host", "child", "removed")
    assert built == sorted([(h, c, gone) for h in ("x", None) for c, gone in (("a", True), ("b", False))], key=repr)


@pytest.mark.parametrize("policy", [CUT, HotKeyPolicy()])
def test_versions_as_of_a_time(spark, policy):
    """A key with more than a third of all rows, several versions, null keys and values."""
    at = lambda n: START + datetime.timedelta(seconds=n)
    keys = lambda i: "hot" if i % 2 else (None if i % 10 == 0 else f"k{i % 7}")
    asked = [(i, keys(i), at(i * 7 % 200) if i % 31 else None) for i in range(200)]
    read = [(keys(i), at(i), None if i % 17 == 0 else f"v{i // 40}", i) for i in range(5, 190, 3)]
    readings = spark.createDataFrame(read, "k STRING, ts TIMESTAMP, value STRING, n INT")
    versions = VS.versions_of(readings, ["k"], "ts", ["n"], ["value"], policy)
    found = VS.as_of_join(spark.createDataFrame(asked, "id INT, k STRING, ts TIMESTAMP"), versions, ["k"], "ts", ["value", "valid_from"], policy)

    def holds(k, t):
        past = [(r[1], r[2]) for r in read if r[0] == k and t is not None and r[1] <= t]
        return past[-1][1] if past else None

    assert {r.id: r.value for r in found.collect()} == {i: holds(k, t) for i, k, t in asked}
    ordered = rows(VS.valid_to(versions, ["k"]), "k", "valid_from", "valid_to", "value")
    for k in {r[0] for r in ordered}:
        own = [r for r in ordered if r[0] == k]
        own.sort(key=lambda r: r[1])
        assert [r[2] for r in own] == [r[1] for r in own[1:]] + [None]
        assert all(a[3] != b[3] for a, b in zip(own, own[1:], strict=False))
