"""Segmented per-key operators against brute force, with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from fleetspan.operators import counters, events, groups
from fleetspan.operators.skew import HotKeyPolicy, cut, hot_keys, with_last_known, with_previous, with_row_number, with_running_sum

CUT = HotKeyPolicy(min_rows=20, skip_below_bytes=0)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    keys = ["hot"] * 300 + [None] * 90 + [f"k{i % 40}" for i in range(200)]
    rng.shuffle(keys)
    return [(k, i // 2, i, rng.choice([None, 1, 2, 5])) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k STRING, ts BIGINT, id BIGINT, v BIGINT").repartition(5)


def per_key(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        found.setdefault(r[0], []).append(r)
    return found


def test_hot_keys_are_the_largest(df):
    found = {r["k"]: r["_rows"] for r in hot_keys(df, ["k"], CUT).collect()}
    assert found == {"hot": 300, None: 90}


def test_no_hot_key_means_no_cut(df):
    assert hot_keys(df, ["k"], HotKeyPolicy(min_rows=1000, skip_below_bytes=0)) is None


def test_previous(df, rows):
    expected = set()
    for group in per_key(rows).values():
        before = None
        for r in group:
            expected.add((*r, -1 if before is None else before[3], None if before is None else before[2]))
            before = r
    out = with_previous(df, ["k"], ["ts", "id"], {"pv": ("v", F.lit(-1).cast("bigint")), "pid": ("id", None)}, CUT)
    assert {tuple(r) for r in out.select("k", "ts", "id", "v", "pv", "pid").collect()} == expected
    assert out.count() == len(rows)


def test_running_sum(df, rows):
    expected = set()
    for group in per_key(rows).values():
        total, n = None, 0
        for r in group:
            total = r[3] if total is None else total + (r[3] or 0)
            n += 1
            expected.add((r[2], total, n))
    out = with_running_sum(df, ["k"], ["ts", "id"], {"s": F.col("v"), "n": F.lit(1).cast("bigint")}, CUT)
    assert {tuple(r) for r in out.select("id", "s", "n").collect()} == expected


def test_row_number_by_text_order(df, rows):
    out = groups.instance_keys(df.filter("k is not null"), "k", F.col("id"), policy=CUT)
    expected = set()
    for key, group in per_key(rows).items():
        if key is not None:
            for n, r in enumerate(sorted(group, key=lambda r: str(r[2]))):
                expected.add((r[2], f"{key}|{n}"))
    assert {tuple(r) for r in out.select("id", "instance_key").collect()} == expected


def test_two_key_columns(df, rows):
    out = with_row_number(df.withColumn("p", F.col("id") % 2), ["k", "p"], ["id"], "n", CUT)
    seen = {}
    expected = set()
    for r in sorted(rows, key=lambda r: r[2]):
        seen[(r[0], r[2] % 2)] = n = seen.get((r[0], r[2] % 2), 0) + 1
        expected.add((r[2], n))
    assert {tuple(r) for r in out.select("id", "n").collect()} == expected


@pytest.mark.parametrize("policy", [CUT, HotKeyPolicy()])
def test_exit_events_do_not_depend_on_the_cut(df, policy):
    runs = df.withColumn("code", (F.col("id") * 7 % 11 % 4).cast("int"))
    out = events.exit_events(runs, ["k"], ["ts", "id"], "code", policy=policy)
    plain = events.exit_events(runs, ["k"], ["ts", "id"], "code", policy=HotKeyPolicy(min_rows=10**9))
    pick = ["k", "id", "code", "previous", "severity", "detail"]
    assert sorted(map(repr, out.select(*pick).collect())) == sorted(map(repr, plain.select(*pick).collect()))


def test_counter_ratio_does_not_depend_on_the_cut(df):
    samples = with_running_sum(
        df, ["k"], ["id"], {"hits": F.coalesce("v", F.lit(0)).cast("bigint"), "misses": F.lit(1).cast("bigint")}
    ).select("k", F.timestamp_seconds("id").alias("ts"), (F.col("hits") % 97).alias("hits"), "misses")
    cut = counters.delta_ratio(samples, ["k"], "ts", "hits", "misses", policy=CUT)
    whole = counters.delta_ratio(samples, ["k"], "ts", "hits", "misses")
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, whole.collect()))
    rates = counters.counter_rate(samples, ["k"], "ts", "hits", policy=CUT)
    assert sorted(map(repr, rates.collect())) == sorted(map(repr, counters.counter_rate(samples, ["k"], "ts", "hits").collect()))


def test_a_cut_reads_its_input_twice(spark, df, tmp_path):
    """Once for the counts, without the aggregation, once to be written; later readers read what was written."""
    path = str(tmp_path / "samples")
    df.select("k", F.timestamp_seconds("id").alias("ts"), F.col("id").alias("hits"), F.col("id").alias("misses")).write.parquet(path)
    out = counters.delta_ratio(spark.read.parquet(path), ["k"], "ts", "hits", "misses", policy=CUT)
    assert out.inputFiles() and not [f for f in out.inputFiles() if path in f]
    assert out.count()


def test_operators_share_a_cut(df):
    shared = cut(df, ["k"], ["ts", "id"], CUT)
    assert shared.hot is not None
    both = shared.previous({"before": ("v", F.lit(-1))}).running_sum({"total": F.col("before")}).last_known({"last": ("total", F.col("v").isNotNull())}).rows
    steps = with_previous(df, ["k"], ["ts", "id"], {"before": ("v", F.lit(-1))})
    steps = with_running_sum(steps, ["k"], ["ts", "id"], {"total": F.col("before")})
    steps = with_last_known(steps, ["k"], ["ts", "id"], {"last": ("total", F.col("v").isNotNull())})
    assert sorted(map(repr, both.select(*steps.columns).collect())) == sorted(map(repr, steps.collect()))
