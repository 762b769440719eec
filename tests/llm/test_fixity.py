import numpy as np

from fleetspan.llm import fixity

SCHEMA = "file long, offset long, payload string, hash string, parent int"


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_damage_is_located(spark):
    draw = np.random.default_rng(6)
    rows = [(f, int(o), f"record {f} {o}") for f in range(3) for o in np.cumsum(draw.integers(1, 40, 300))]
    other = [list(r) for r in rows]
    other[10][2], other[400][2] = "spoilt", None
    gone, twice = other.pop(700), other[50]
    other += [twice, [7, 5, "of an unknown file"], [0, 10**9, "far out"]]
    found = {(r.file, r.offset): (r.kind, r.n_records, r.n_other) for r in fixity.audit(made(spark, rows), made(spark, map(tuple, other))).collect()}
    assert found == {
        (rows[10][0], rows[10][1]): ("changed", 1, 1),
        (rows[400][0], rows[400][1]): ("changed", 1, 1),
        (gone[0], gone[1]): ("missing", 1, 0),
        (twice[0], twice[1]): ("extra", 1, 2),
        (7, 5): ("extra", 0, 1),
        (0, 10**9): ("extra", 0, 1),
    }


def test_order_ties_nulls_and_empty(spark):
    rows = [(1, 5, "a"), (1, 5, "b"), (1, 5, "b"), (None, 3, "x"), (None, None, None), (2, None, ""), (2, 9, "y" * 200_000)]
    a, b = made(spark, rows), made(spark, rows[::-1])
    assert fixity.audit(a, b).count() == 0
    changed = [r for r in rows if r != (None, None, None)] + [(None, None, "")]
    assert [(r.file, r.offset, r.kind) for r in fixity.audit(a, made(spark, changed)).collect()] == [(None, None, "changed")]
    assert fixity.audit(a, a.limit(0)).count() == 5
    assert fixity.audit(a.limit(0), a.limit(0)).count() == 0


def test_only_differing_branches_are_read(spark):
    rows = made(spark, [(1, i, f"r{i}") for i in range(2000)])
    levels = fixity.tree(fixity.leaves(rows, 0))
    assert [x.count() for x in levels] == [2000, 125, 8, 1, 1]


def test_nodes_have_few_children_at_any_offset(spark):
    draw = np.random.default_rng(7)
    offsets = sorted({int(o) for o in draw.integers(0, 10**9, 3000)} | {0, 2**36, 2**36 + 1, -1, -(2**34)})
    rows = [(1, o, f"r{o}") for o in offsets] + [(1, None, "n")]
    levels = fixity.tree(fixity.leaves(made(spark, rows), 0))
    for level in levels[:-1]:
        most = level.groupBy("parent").count().agg({"count": "max"}).first()[0]
        assert most <= fixity.FANOUT
    assert levels[-1].count() == 1 and levels[-2].count() == 3
    other = [r for r in rows if r[1] != 2**36] + [(1, -5, "new")]
    found = fixity.audit(made(spark, rows), made(spark, other)).collect()
    assert {(r.offset, r.kind) for r in found} == {(2**36, "missing"), (-5, "extra")}
