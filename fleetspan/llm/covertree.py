"""Hard negatives from a cover tree over norm-augmented vectors.

Every candidate gets one more component, so that all have the norm of the
longest one; a query has 0 there. Inner products are then cosines on a sphere,
and a node that covers its rows within a radius (an angle) bounds the inner
products of all of them from above and below.

1. Top of the tree: a farthest-first order of a bounded sample; its prefixes at
   shrinking radii are the levels, the last of them the cells. Every row goes to
   its nearest cell, and the covering radii of all levels are taken over all rows.
2. Cells are cut into shards of bounded size, and every shard into leaves around
   its own farthest points.
3. Queries search in blocks. A block descends the levels and keeps the cells that
   a query's window and best scores so far let in. Its leaves reach the tasks best
   bound first; a leaf outside a query's window, or below its k-th score, is
   skipped, the others are verified with exact integer products.

Two searches make the triples: the best rows of the anchor's own label, then the
best rows of other labels within the window that each positive's score sets.

Defined results: rows with a null id, label or vector, with null or non-finite
components or none, and vectors of another length than most take no part, nor
do components so large that a score might exceed a long. Of rows with the same id the one with the
smallest label and vector counts. Ties go to the smaller id. Of equal vectors
with one label only the smallest ids can be among the k best, so the others are
not indexed; this loses nothing. An anchor without positives, and a positive
without rows in its window, give no rows. An empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetspan.llm.common import query, table
from fleetspan.session import local_table, materialize

#: Rows the top of the tree is fitted on, chosen by a hash, and those that give queries their first bounds; every row is indexed.
MAX_SAMPLE, FIRST_LOOK = 20_000, 4096
#: Rows of a cell that the number of cells aims at, most cells, rows of a shard and of a leaf.
CELL_SIZE, MAX_CELLS, SHARD, LEAF = 512, 1024, 4096, 64
#: How fast the radii of the levels shrink, and the least growth from one level to the next.
BASE, GROWTH = 1.3, 2
#: Searches of a block, and tasks that share the candidates of a block.
BLOCK, LANES = 4096, 16
#: Slack of angles, above the rounding of an arc cosine.
SLACK = 1e-6
LEAST, MOST = -(2**63), 2**63 - 1

INDEX = "cell int, shard int, center array<double>, radius double, ids array<long>, labels array<long>, vectors array<int>"
RESULT = "qid long, lo long, hi long, id long, score long"


def farthest_first(points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of n points, each the farthest from those before it, the angles at which they were added, and the nearest of each point.

    ``points`` are unit vectors. Copies of chosen points are not chosen.
    """
    chosen, added = [0], [np.pi]
    best = points @ points[0]
    own = np.zeros(len(points), int)
    while len(chosen) < min(n, len(points)):
        far = int(best.argmin())
        if best[far] >= 1 - 1e-12:
            break
        added.append(float(np.arccos(np.clip(best[far], -1, 1))))
        near = points @ points[far]
        closer = near > best
        own[closer], best = len(chosen), np.where(closer, near, best)
        chosen.append(far)
    return np.array(chosen), np.array(added), own


def augmented(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Unit vectors in one more dimension: each vector lifted to ``norm``."""
    vectors = vectors.astype(float)
    lift = np.sqrt(np.maximum(0.0, norm**2 - (vectors**2).sum(1)))
    lifted = np.hstack([vectors, lift[:, None]])
    return lifted / np.maximum(np.sqrt((lifted**2).sum(1, keepdims=True)), 1e-300)


@dataclass(frozen=True)
class Tree:
    """Levels of centers (unit vectors in farthest-first order), the first ``sizes[i]`` of them at level i."""

    centers: np.ndarray
    sizes: tuple[int, ...]
    #: By level: parent of each node in the level above.
    parents: tuple[np.ndarray, ...]
    norm: float
    #: By level: covering angle of each node over all rows below it; -1 where there are none.
    radii: tuple[np.ndarray, ...] = ()

    def ancestors(self, cells: np.ndarray) -> list[np.ndarray]:
        """By level, the node above each cell, the cell itself last."""
        path = [cells]
        for parent in reversed(self.parents[1:]):
            path.append(parent[path[-1]])
        return path[::-1]


def fit_tree(sample: np.ndarray, n: int, norm: float) -> Tree:
    """The top of the tree over the sample."""
    points = augmented(sample, norm)
    chosen, added, _ = farthest_first(points, n)
    centers, sizes, radius = points[chosen], [1], np.pi
    while sizes[-1] < len(chosen):
        radius /= BASE
        size = int((added > radius).sum())
        if size >= GROWTH * sizes[-1]:
            sizes.append(size)
        elif radius < SLACK:
            sizes.append(len(chosen))
    sizes[-1] = len(chosen)
    parents = [np.zeros(1, int)]
    for above, size in zip(sizes, sizes[1:], strict=False):
        parent = (centers[:size] @ centers[:above].T).argmax(1)
        parent[:above] = np.arange(above)
        parents.append(parent)
    return Tree(centers, tuple(sizes), tuple(parents), norm)


def bounds(unit: np.ndarray, scale: np.ndarray, centers: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most inner product of each query with the rows of each node.

    ``unit`` are the queries by their norm, ``scale`` that norm times the rows' common norm.
    """
    angle = np.arccos(np.clip(unit @ centers[:, :-1].T, -1, 1))
    room = radii[None, :] + SLACK
    most = np.cos(np.maximum(0, angle - room)) * scale[:, None]
    least = np.cos(np.minimum(np.pi, angle + room)) * scale[:, None]
    slack = 0.5 + 1e-9 * scale[:, None]
    return least - slack, most + slack


def _ints(column, width: int) -> np.ndarray:
    flat = np.asarray(column.flatten())
    return flat.reshape(-1, width)


def products(queries: np.ndarray, vectors: np.ndarray, exact: bool) -> np.ndarray:
    """Exact inner products: by floating point where they stay below 2^53, else by integers."""
    if exact:
        return (queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    return queries.astype(np.int64) @ vectors.astype(np.int64).T


class Best:
    """The k best (score, smaller id first) of each search."""

    def __init__(self, n: int, k: int, first: np.ndarray):
        self.n, self.k, self.least = n, k, first.copy()
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append((row, score, ids))
        self.waiting += len(row)
        if self.waiting > max(4096, self.n * self.k):
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            none = np.zeros(0, np.int64)
            return none, none, none
        row, score, ids = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        last = place == self.k - 1
        self.least[row[last]] = np.maximum(self.least[row[last]], score[last])
        kept = place < self.k
        self.parts, self.waiting = [(row[kept], score[kept], ids[kept])], 0
        return self.parts[0]


@dataclass
class Block:
    """A block of searches: query vectors, labels, windows of scores, and what has been found."""

    qid: np.ndarray
    label: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    vectors: np.ndarray
    same: bool
    exact: bool
    norm: float

    def __post_init__(self):
        length = np.maximum(1.0, np.sqrt((self.vectors.astype(float) ** 2).sum(1)))
        self.unit, self.scale = self.vectors / length[:, None], length * self.norm

    def wanted(self, least: np.ndarray, centers: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each node may hold a result of each search, and the most it can score there."""
        low, most = bounds(self.unit, self.scale, centers, radii)
        floor = np.maximum(self.lo, least).astype(float)[:, None]
        return (most >= floor) & (low <= self.hi.astype(float)[:, None]), np.minimum(most, self.hi.astype(float)[:, None])

    def look(self, best: Best, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        """Verify a leaf for some searches."""
        score = products(self.vectors[rows], vectors, self.exact)
        fits = (labels[None, :] == self.label[rows][:, None]) == self.same
        fits &= (score >= np.maximum(self.lo, best.least)[rows][:, None]) & (score <= self.hi[rows][:, None])
        r, c = np.nonzero(fits)
        if len(r):
            best.add(rows[r], score[r, c], ids[c])


def _assign(tree: Tree, width: int):
    """Adds the nearest cell, and the angle to the node above the row at every level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = augmented(_ints(batch["vector"], width), tree.norm)
            cells = np.zeros(len(points), int)
            for i in range(0, len(points), 2048):
                cells[i : i + 2048] = (points[i : i + 2048] @ tree.centers.T).argmax(1)
            far = [np.arccos(np.clip((points * tree.centers[a]).sum(1), -1, 1)) for a in tree.ancestors(cells)]
            columns = [pa.array(cells, pa.int32()), pa.array(list(np.array(far).T), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "cell", "far"])

    return run


def _leaves(width: int, norm: float, leaf: int):
    """Cuts a shard into leaves around its farthest points; a row of the result is a leaf."""

    def run(rows: pa.Table) -> pa.Table:
        vectors, ids, labels = (
            _ints(rows["vector"].combine_chunks(), width),
            rows["id"].to_numpy(),
            rows["label"].to_numpy(),
        )
        points = augmented(vectors, norm)
        chosen, _, own = farthest_first(points, -(-len(points) // leaf))
        out: list[tuple] = []
        for i, center in enumerate(chosen):
            members = np.flatnonzero(own == i)
            for start in range(0, len(members), 4 * leaf):
                part = members[start : start + 4 * leaf]
                radius = float(np.arccos(np.clip(points[part] @ points[center], -1, 1)).max())
                out.append((points[center], radius, ids[part], labels[part], vectors[part].ravel()))
        center, radius, id_, label, vector = zip(*out, strict=True)
        n = len(out)
        return pa.table(
            {
                "cell": pa.array([rows["cell"][0].as_py()] * n, pa.int32()),
                "shard": pa.array([rows["shard"][0].as_py()] * n, pa.int32()),
                "center": pa.array(center, pa.list_(pa.float64())),
                "radius": pa.array(radius, pa.float64()),
                "ids": pa.array(id_, pa.list_(pa.int64())),
                "labels": pa.array(label, pa.list_(pa.int64())),
                "vectors": pa.array(vector, pa.list_(pa.int32())),
            }
        )

    return run


@dataclass(frozen=True)
class Index:
    """The indexed rows: leaves in Spark, the top of the tree and a first look on the driver."""

    leaves: DataFrame
    tree: Tree
    #: Rows of each (cell, shard).
    shards: DataFrame
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]
    width: int
    exact: bool


def build_index(rows: DataFrame, width: int, norm: float, exact: bool) -> Index | None:
    """Index of rows (id, label, vector of ``width`` whole numbers), or None without rows."""
    spark = rows.sparkSession
    n = rows.count()
    if not n:
        return None
    drawn = rows.orderBy(F.xxhash64("vector"), "id").limit(MAX_SAMPLE).toArrow()
    vectors = _ints(drawn["vector"].combine_chunks(), width)
    first = drawn["id"].to_numpy()[:FIRST_LOOK], drawn["label"].to_numpy()[:FIRST_LOOK], vectors[:FIRST_LOOK]
    norm = max(1.0, norm)
    tree = fit_tree(vectors, min(MAX_CELLS, -(-n // CELL_SIZE)), norm)

    schema = "id long, label long, vector array<int>, cell int, far array<double>"
    placed = materialize(rows.mapInArrow(_assign(tree, width), schema), "cover-placed")
    levels = range(len(tree.sizes))
    # One row per cell: MAX_CELLS at most.
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), *[F.max(F.col("far")[i]).alias(f"r{i}") for i in levels]).toArrow()
    cell, path = cells["cell"].to_numpy(), tree.ancestors(cells["cell"].to_numpy())
    radii = tuple(np.full(size, -1.0) for size in tree.sizes)
    for i in levels:
        np.maximum.at(radii[i], path[i], cells[f"r{i}"].to_numpy())
    tree = Tree(tree.centers, tree.sizes, tree.parents, norm, radii)

    cuts = [(int(c), math.ceil(m / SHARD)) for c, m in zip(cell, cells["n"].to_numpy(), strict=True)]
    shards = local_table(spark, cuts, "cell int, cuts int")
    dealt = placed.join(F.broadcast(shards), "cell")  # MAX_CELLS rows of 8 bytes
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int"))
    leaves = dealt.select("cell", "shard", "id", "label", "vector").groupBy("cell", "shard").applyInArrow(_leaves(width, norm, LEAF), INDEX)
    return Index(materialize(leaves, "cover-leaves"), tree, shards, first, width, exact)


PACKED = "block int, qid array<long>, label array<long>, lo array<long>, hi array<long>, least array<long>, vectors array<int>, cells array<int>, most array<double>"


def _pack(index: Index, same: bool, k: int):
    """One row per block: its searches, their first bounds, and the cells that a descent of the levels lets in."""
    # The tasks take these, not the index: that holds DataFrames.
    tree, width, exact, (ids, labels, vectors) = index.tree, index.width, index.exact, index.sample

    def run(rows: pa.Table) -> pa.Table:
        names = ("qid", "label", "lo", "hi")
        block = Block(*(rows[c].to_numpy() for c in names), _ints(rows["vector"].combine_chunks(), width), same, exact, tree.norm)
        n = len(block.qid)
        best = Best(n, k, np.full(n, LEAST))
        for start in range(0, n, 256):
            block.look(best, np.arange(start, min(n, start + 256)), ids, labels, vectors)
        best.settle()
        found: dict[int, float] = {}
        for start in range(0, n, 1024):
            part = slice(start, start + 1024)
            piece = Block(block.qid[part], block.label[part], block.lo[part], block.hi[part], block.vectors[part], same, exact, tree.norm)
            alive = np.ones((len(piece.qid), 1), bool)
            for size, parent, radius in zip(tree.sizes, tree.parents, tree.radii, strict=True):
                wanted, most = piece.wanted(best.least[part], tree.centers[:size], radius)
                alive = alive[:, parent] & wanted & (radius >= 0)
            for cell in np.flatnonzero(alive.any(0)):
                found[int(cell)] = max(found.get(int(cell), -np.inf), float(most[alive[:, cell], cell].max()))
        lists = {**{c: rows[c].to_numpy() for c in names}, "least": best.least, "vectors": block.vectors.ravel()}
        columns = {c: pa.array([v], pa.list_(pa.int32() if c == "vectors" else pa.int64())) for c, v in lists.items()}
        columns |= {"cells": pa.array([[*found]], pa.list_(pa.int32())), "most": pa.array([[*found.values()]], pa.list_(pa.float64()))}
        return pa.table({"block": rows["block"].slice(0, 1), **columns})

    return run


def _search(width: int, norm: float, exact: bool, same: bool, k: int):
    """Reads, by block and lane, the block's searches and then its leaves, best first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block | None = None
        best = Best(0, k, np.zeros(0, np.int64))

        def results() -> pa.RecordBatch:
            row, score, ids = best.settle()
            columns = [block.qid[row], block.lo[row], block.hi[row], ids, score] if block else [np.zeros(0, np.int64)] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["qid", "lo", "hi", "id", "score"])

        for batch in batches:
            heads = np.flatnonzero(batch["kind"].to_numpy() == 0)
            # Leaves that go on with the block before, then those after each head.
            for start, end in zip([-1, *heads], [*heads, batch.num_rows], strict=True):
                if start >= 0:
                    yield results()
                    names = ("qid", "label", "lo", "hi")
                    block = Block(*(np.asarray(batch[c][start].values) for c in names), _ints(batch["vectors"].slice(start, 1), width), same, exact, norm)
                    best = Best(len(block.qid), k, np.asarray(batch["least"][start].values))
                if block is None or end <= start + 1:
                    continue
                part = batch.slice(start + 1, end - start - 1)
                centers = np.asarray(part["center"].flatten()).reshape(-1, width + 1)
                radii = part["radius"].to_numpy()
                first = block.wanted(best.least, centers, radii)
                top = np.where(first[0], first[1], -np.inf).max(0)
                for leaf in np.argsort(-top, kind="stable"):
                    if not np.isfinite(top[leaf]):
                        break
                    wanted, _ = block.wanted(best.least, centers[leaf : leaf + 1], radii[leaf : leaf + 1])
                    rows = np.flatnonzero(wanted[:, 0])
                    if len(rows):
                        leaf_ids, leaf_labels = (np.asarray(part[c][int(leaf)].values) for c in ("ids", "labels"))
                        for i in range(0, len(rows), 1024):
                            block.look(best, rows[i : i + 1024], leaf_ids, leaf_labels, _ints(part["vectors"].slice(int(leaf), 1), width))
        yield results()

    return run


def search(index: Index, searches: DataFrame, same: bool, k: int) -> DataFrame:
    """The k best rows of each search (qid, label, vector, lo, hi): those with its label or, where ``same`` is false, another one.

    Columns: qid, lo, hi, id, score, rank from 1.
    """
    spark, tree = searches.sparkSession, index.tree
    placed = searches.mapInArrow(_assign(tree, index.width), "qid long, label long, vector array<int>, lo long, hi long, cell int, far array<double>")
    placed = materialize(placed.drop("far"), "cover-searches")
    # One row per cell: MAX_CELLS at most. Blocks take searches of neighbouring cells.
    counts = placed.groupBy("cell").agg(F.count("*").alias("n")).orderBy("cell").toArrow()
    sizes = counts["n"].to_numpy()
    offsets = local_table(
        spark,
        [(int(c), int(o), int(m)) for c, o, m in zip(counts["cell"].to_numpy(), np.cumsum(sizes) - sizes, sizes, strict=True)],
        "cell int, before long, n long",
    )
    place = F.col("before") + F.floor(F.pmod(F.xxhash64("qid", "lo", "hi"), F.lit(1 << 20)) / (1 << 20) * F.col("n"))
    blocks = placed.join(F.broadcast(offsets), "cell").withColumn("block", F.floor(place / BLOCK).cast("int"))
    packed = blocks.select("block", "qid", "label", "lo", "hi", "vector").groupBy("block").applyInArrow(_pack(index, same, k), PACKED)
    packed = materialize(packed, "cover-blocks")

    reads = packed.select("block", F.explode(F.arrays_zip("cells", "most")).alias("c")).select("block", F.col("c.cells").alias("cell"), F.col("c.most").alias("most"))
    # One row per block and shard.
    reads = reads.join(F.broadcast(index.shards), "cell").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    reads = reads.drop("cuts").withColumn("lane", F.pmod(F.xxhash64("cell", "shard"), F.lit(LANES)).cast("int"))
    heads = reads.select("block", "lane").distinct().join(packed.drop("cells", "most"), "block").withColumn("kind", F.lit(0))
    leaves = reads.join(index.leaves, ["cell", "shard"]).withColumn("kind", F.lit(1))
    stream = heads.unionByName(leaves, allowMissingColumns=True)
    stream = stream.repartition("block", "lane").sortWithinPartitions("block", "lane", "kind", F.desc("most"), "cell", "shard")
    stream = stream.select("kind", "qid", "label", "lo", "hi", "least", "center", "radius", "ids", "labels", "vectors")
    found = stream.mapInArrow(_search(index.width, tree.norm, index.exact, same, k), RESULT)
    order = Window.partitionBy("qid", "lo", "hi").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """Rows (id, label, vector of whole doubles) that take part, their length, and the largest component."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(finite)
    most = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    width = most["n"] if most else 1
    # A hundredfold inner product must fit a long.
    limit = min(2**31 - 1, math.isqrt((2**63 - 1) // 100 // width))
    rows = rows.where(F.size(v) == width).where(F.forall(v, lambda x: F.abs(x) <= limit))
    rows = rows.groupBy("id").agg(F.min(F.struct("label", F.col("vector").cast("array<int>").alias("vector"))).alias("row"))
    return rows.select("id", "row.label", "row.vector"), width, limit


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Negatives of each anchor and positive; ``rows`` have id, label and vector (whole numbers as doubles).

    ``is_anchor`` is a condition on ``id``. A negative's score lies between ``low`` and ``high`` hundredths of the positive's.
    """
    found, width, _ = usable(rows)
    found = materialize(found, "cover-rows")
    square = F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long"))
    size = found.agg(F.max(square).alias("square")).first()["square"] or 0
    copies = Window.partitionBy("label", "vector").orderBy("id")
    kept = found.withColumn("place", F.row_number().over(copies)).where(F.col("place") <= max(positives + 1, negatives)).drop("place")
    index = build_index(materialize(kept, "cover-candidates"), width, math.sqrt(size), size < 2**53)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if index is None:
        return rows.sparkSession.createDataFrame([], schema)

    # Anchors with equal vectors and labels share a search.
    anchors = found.where(is_anchor)
    asked = materialize(anchors.groupBy("label", "vector").agg(F.min("id").alias("qid")), "cover-asked")
    whole = asked.select("qid", "label", "vector", F.lit(LEAST).alias("lo"), F.lit(MOST).alias("hi"))
    near = search(index, whole, True, positives + 1).select("qid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = anchors.join(asked, ["label", "vector"]).select(F.col("id").alias("anchor_id"), "qid").join(near, "qid")
    pairs = pairs.where(F.col("positive_id") != F.col("anchor_id"))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    pairs = pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives).drop("place")
    p = "positive_score"
    pairs = pairs.withColumn("lo", F.expr(f"({low} * {p} + pmod(-{low} * {p}, 100)) div 100")).withColumn("hi", F.expr(f"({high} * {p} - pmod({high} * {p}, 100)) div 100"))
    pairs = materialize(pairs.where(F.col("lo") <= F.col("hi")), "cover-positives")

    windows = pairs.select("qid", "lo", "hi").distinct().join(asked, "qid").select("qid", "label", "vector", "lo", "hi")
    hard = search(index, windows, False, negatives).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    return pairs.join(hard, ["qid", "lo", "hi"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


SQL = """
with usable as (
    select vec_id, label, embedding from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), rows as (
    select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as vector
    from usable
), scores as (
    select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
           list_inner_product(a.vector, b.vector)::bigint as score
    from rows a join rows b on a.vec_id <> b.vec_id
    where a.vec_id % 100 = 0
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scores where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), negatives as (
    select p.anchor_id, p.positive_id, s.vec_id as negative_id, p.positive_score, s.score as negative_score,
           row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id)::int as rank
    from positives p join scores s on s.anchor_id = p.anchor_id and not s.same
    where 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 10
"""


@query(SQL)
def op11_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(256 * x).cast("double")).alias("vector"),
    )
    return mine(rows, F.col("id") % 100 == 0)
