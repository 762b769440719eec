"""Approximate nearest neighbours with balanced posting lists.

Centroids are fitted on a bounded sample with a handicap for large clusters and
held with a neighbour graph in memory; the graph finds the centroids near a
vector. Each vector goes to the posting list of its nearest centroid, a vector
near a boundary to several. A query reads all lists whose centroids are within
a ratio of its nearest centroid's distance: the graph search keeps more and more
centroids until the farthest one is outside. Lists are cut into shards and their
queries into batches, both of bounded size, so a dense region is searched by
many tasks.

The ratio is measured in the job: for a sample of the queries all vectors are
compared, and the ratio is raised until the lists within it hold RECALL of the
sample's true neighbours. So the recall does not fall as the table grows.

Equal vectors are searched once: of each distinct vector only the K + 1
smallest ids can be among the K nearest, so the others need not be indexed one
by one, and queries with equal vectors share one search. This loses nothing.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and vectors of another length than most, take no part, neither as
queries nor as candidates; so do null ids. Repeated rows count once. Distances
are Euclidean in double precision on the given vectors, ties go to the smaller
id. With fewer candidates than K all that were found are returned. An empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetspan.llm.common import query, table
from fleetspan.session import materialize

#: Distinct vectors that centroids are fitted on, chosen by a hash; every vector is indexed.
MAX_SAMPLE = 20_000
#: Distinct vectors per list that the number of centroids aims at, and most centroids.
LIST_SIZE, MAX_LISTS = 250, 2048
#: Rows of a shard of a list, and queries of a batch that reads it.
SHARD, ASKED = 4096, 4096
#: A vector also goes to lists whose centroids are at most so much farther than its nearest one, and to so many lists in all.
BOUNDARY_RATIO, COPIES = 1.05, 3
#: A query reads the lists whose centroids are so much farther than its nearest one, or more if RECALL needs it.
SEARCH_RATIO = 1.1
#: Share of the true neighbours of the sampled queries that the read lists must hold, and number of sampled queries.
RECALL, PROBES = 0.95, 128
#: Centroids that the graph search keeps when a vector is indexed, and at first when it is a query; neighbours of each, entries, steps at most.
BEAM, FIRST_BEAM, DEGREE, ENTRIES, STEPS = 8, 64, 24, 32, 12


class Centroids:
    """Centroids with a neighbour graph; the graph is made anew in each task from the centroids alone."""

    def __init__(self, points: np.ndarray):
        self.points = points
        near = squared(points, points)
        n = len(points)
        self.neighbours = np.argsort(near, axis=1, kind="stable")[:, : min(n, DEGREE + 1)]
        entries = [0]  # spread over the space: each is the farthest from those before
        least = near[0].copy()
        while len(entries) < min(n, ENTRIES):
            entries.append(int(least.argmax()))
            least = np.minimum(least, near[entries[-1]])
        self.entries = np.array(entries)

    def nearest(self, vectors: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids found from each vector, nearest first, and their squared distances."""
        vectors = np.hstack([vectors, np.zeros((len(vectors), 1))])
        n, beam = len(self.points), min(beam, len(self.points))
        places, distances = [], []
        for start in range(0, len(vectors), 128):
            part = vectors[start : start + 128]
            known = np.full((len(part), n), np.inf)
            known[:, self.entries] = squared(part, self.points[self.entries])
            best = np.argpartition(known, beam - 1, axis=1)[:, :beam]
            expanded = np.zeros((len(part), n), bool)
            for _ in range(STEPS):
                front = np.take_along_axis(np.isfinite(known) & ~expanded, best, 1)
                row, at = np.nonzero(front)
                if not len(row):
                    break
                node = best[row, at]
                expanded[row, node] = True
                row, node = np.repeat(row, self.neighbours.shape[1]), self.neighbours[node].ravel()
                new = ~np.isfinite(known[row, node])
                row, node = row[new], node[new]
                known[row, node] = ((part[row] - self.points[node]) ** 2).sum(1)
                best = np.argpartition(known, beam - 1, axis=1)[:, :beam]
            distance = np.take_along_axis(known, best, 1)
            order = np.argsort(distance, axis=1, kind="stable")
            places.append(np.take_along_axis(best, order, 1))
            distances.append(np.take_along_axis(distance, order, 1))
        if not places:
            return np.zeros((0, beam), int), np.zeros((0, beam))
        return np.vstack(places), np.vstack(distances)

    def lists(self, vectors: np.ndarray) -> list[list[int]]:
        """Lists of each vector: the nearest, and those hardly farther."""
        places, distances = self.nearest(vectors)
        return [p[d <= d[0] * BOUNDARY_RATIO**2][:COPIES].tolist() for p, d in zip(places, distances, strict=True)]

    def within(self, vectors: np.ndarray, ratio: float) -> list[list[int]]:
        """Lists that each query reads: all centroids found at most ``ratio`` times as far as its nearest."""
        out: list[list[int]] = [[] for _ in vectors]
        open_, beam = np.arange(len(vectors)), FIRST_BEAM
        while len(open_):
            places, distances = self.nearest(vectors[open_], beam)
            near = distances <= distances[:, :1] * ratio**2
            # Done once the farthest kept centroid is outside, or all are kept.
            done = ~near[:, -1] | (beam >= len(self.points))
            for at in np.flatnonzero(done):
                out[open_[at]] = places[at, near[at]].tolist()
            open_, beam = open_[~done], beam * 4
        return out


def ratios(points: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """How much farther each centroid is from each vector than the nearest one; all centroids are compared."""
    distance = squared(np.hstack([vectors, np.zeros((len(vectors), 1))]), points)
    least = distance.min(1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(distance == least, 1.0, np.sqrt(distance / least))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T)


def fit_centroids(sample: np.ndarray, n: int, rounds: int = 20) -> np.ndarray:
    """Lloyd's rounds with a handicap for large clusters.

    The handicap is added to the squared distance. It is returned as one more
    coordinate of the centroids (vectors have 0 there), so that index and
    search use the same balanced distance.
    """
    draw = np.random.default_rng(3)
    n = max(1, min(n, len(sample)))
    points, handicap = sample[draw.choice(len(sample), n, replace=False)].copy(), np.zeros(n)
    for step in range(rounds):
        own, near = np.zeros(len(sample), int), np.zeros(len(sample))
        for i in range(0, len(sample), 4096):
            d = squared(sample[i : i + 4096], points) + handicap
            own[i : i + 4096] = d.argmin(1)
            near[i : i + 4096] = np.take_along_axis(d, own[i : i + 4096, None], 1)[:, 0] - handicap[own[i : i + 4096]]
        size = np.bincount(own, minlength=n)
        # In the units of the cluster's own spread, as dense and wide clusters may lie side by side.
        spread = (np.bincount(own, np.maximum(near, 0), n) + near.mean()) / (size + 1)
        handicap += 0.1 * spread * np.log((size + 1) / (len(sample) / n + 1)) / (1 + step / 5)
        if step < rounds // 2:
            total = np.zeros_like(points)
            np.add.at(total, own, sample)
            points[size > 0] = total[size > 0] / size[size > 0, None]
    return np.hstack([points, np.sqrt(handicap - handicap.min())[:, None]])


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id and vector (doubles) of the rows that take part."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull()).where(finite & F.exists(v, lambda x: x != 0))
    most = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size(v) == (most["n"] if most else 0))


def _matrix(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    flat = np.asarray(column.flatten(), float)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _assign(points: np.ndarray, ratio: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(points)
        for batch in batches:
            vectors = _matrix(batch["vector"])
            lists = centroids.lists(vectors) if ratio is None else centroids.within(vectors, ratio)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], [*batch.schema.names, "lists"])

    return run


def _assigned(rows: DataFrame, points: np.ndarray, ratio: float | None = None) -> DataFrame:
    """Rows with each list that indexes them, or with each that a query reads at the ratio."""
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    found = rows.mapInArrow(_assign(points, ratio), f"{kept}, lists array<int>")
    return found.withColumn("list", F.explode("lists")).drop("lists")


def _needs(points: np.ndarray, probes: np.ndarray, k: int):
    """Nearest postings of each probe among a task's, with the ratio at which their list is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = ratios(points, probes)
        # A vector has COPIES postings at most, so these hold the k nearest vectors.
        scores = np.zeros((len(probes), 0))
        needs, ids = scores, scores.astype(np.int64)
        for batch in batches:
            vectors, lists = _matrix(batch["vector"]), batch["list"].to_numpy()
            for i in range(0, len(vectors), 4096):
                own = lists[i : i + 4096]
                scores = np.hstack([scores, squared(probes, vectors[i : i + 4096])])
                needs = np.hstack([needs, needed[:, own]])
                ids = np.hstack([ids, np.broadcast_to(batch["first"].to_numpy()[i : i + 4096], (len(probes), len(own)))])
                if scores.shape[1] > k * COPIES:
                    best = np.argpartition(scores, k * COPIES - 1, axis=1)[:, : k * COPIES]
                    scores, needs, ids = (np.take_along_axis(x, best, 1) for x in (scores, needs, ids))
        probe = np.repeat(np.arange(len(probes)), scores.shape[1])
        columns = [pa.array(probe, pa.int32()), pa.array(ids.ravel()), pa.array(scores.ravel()), pa.array(needs.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["probe", "first", "score", "need"])

    return run


def search_ratio(postings: DataFrame, asked: DataFrame, points: np.ndarray, k: int) -> float:
    """The ratio at which the lists read hold RECALL of the true neighbours of PROBES queries, at least SEARCH_RATIO."""
    probes = asked.select("vector").orderBy(F.xxhash64("vector")).limit(PROBES).toArrow()
    if not probes.num_rows or len(points) == 1:
        return SEARCH_RATIO
    rows = postings.select("vector", "list", F.col("ids")[0].alias("first"))
    found = rows.mapInArrow(_needs(points, _matrix(probes["vector"].combine_chunks()), k + 1), "probe int, first long, score double, need double")
    found = found.groupBy("probe", "first").agg(F.min("score").alias("score"), F.min("need").alias("need"))
    place = F.row_number().over(Window.partitionBy("probe").orderBy("score", "first"))
    # The first is the query itself.
    needs = found.withColumn("place", place).where(F.col("place").between(2, k + 1)).select("need").toArrow()["need"].to_numpy()
    if not len(needs):
        return SEARCH_RATIO
    # The rounding of distances must not put the last list outside.
    return max(SEARCH_RATIO, float(np.quantile(needs, RECALL, method="higher")) * (1 + 1e-9))


def _nearest(k: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        qid: list[int] = []
        ids: list[np.ndarray] = []
        scores: list[np.ndarray] = []
        if len(candidates) and len(queries):
            vectors = np.vstack(candidates["vector"].to_numpy()).astype(float)
            members = candidates["ids"].to_numpy()
            for q, vector in zip(queries["qid"], queries["vector"], strict=True):
                distance = np.sqrt(((vectors - np.asarray(vector, float)) ** 2).sum(1))
                # All that are as near as the k-th distinct vector, so that ties are whole.
                near = np.flatnonzero(distance <= np.partition(distance, min(k, len(distance)) - 1)[min(k, len(distance)) - 1])
                found = np.concatenate([members[i] for i in near])
                score = np.repeat(distance[near], [len(members[i]) for i in near])
                order = np.lexsort((found, score))[:k]
                qid += [q] * len(order)
                ids.append(found[order])
                scores.append(score[order])
        none = [np.zeros(0)]
        return pd.DataFrame({"qid": np.array(qid, np.int64), "vec_id": np.concatenate(ids or none).astype(np.int64), "score": np.concatenate(scores or none)})

    return run


def search(df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest rows of each row for which ``is_query`` (a condition on ``id``) holds.

    Columns: query_id, rank from 1, vec_id, score (the distance).
    """
    rows = usable(df, key, vector)
    # Distinct vectors with their k + 1 smallest ids; the limit is applied before the shuffle.
    by_vector = Window.partitionBy("vector").orderBy("id")
    first = rows.withColumn("place", F.dense_rank().over(by_vector)).where(F.col("place") <= k + 1)
    distinct = materialize(first.groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids")), "posting-vectors")
    n = distinct.count()
    if not n:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = distinct.select("vector").orderBy(F.xxhash64("vector")).limit(MAX_SAMPLE).toArrow()
    points = fit_centroids(_matrix(sample["vector"].combine_chunks()), min(MAX_LISTS, -(-n // LIST_SIZE)))

    postings = materialize(_assigned(distinct, points), "posting-lists")
    asking = rows.where(is_query)
    asked = asking.groupBy("vector").agg(F.min("id").alias("qid"))
    asked = materialize(asked, "posting-queries")
    ratio = search_ratio(postings, asked, points, k)
    # One row per list: MAX_LISTS at most.
    shards = F.broadcast(postings.groupBy("list").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("n")))
    reads = materialize(_assigned(asked, points, ratio), "posting-reads")
    batches = F.broadcast(reads.groupBy("list").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("m")))
    part = lambda n: F.pmod(F.xxhash64("vector"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # Lists that nobody reads go no further.
    postings = postings.join(shards, "list").join(batches, "list").withColumn("shard", part("n")).withColumn("batch", each("m"))
    reads = reads.join(shards, "list").join(batches, "list").withColumn("batch", part("m")).withColumn("shard", each("n"))
    by = ("list", "shard", "batch")
    found = (
        postings.select(*by, "vector", "ids")
        .groupBy(*by)
        .cogroup(reads.select(*by, "vector", "qid").groupBy(*by))
        .applyInPandas(_nearest(k + 1), "qid long, vec_id long, score double")
    )
    # A vector read from several lists counts once.
    best = found.groupBy("qid", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("qid").orderBy("score", "vec_id")
    best = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    queries = asking.select("id", "vector").distinct().join(asked, "vector").select(F.col("id").alias("query_id"), "qid")
    answers = queries.join(best, "qid").where(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    answers = answers.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    answers = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return answers.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query()
def op7_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
