"""Similarity join on sets of word n-grams with MinHash banding.

1. Each text becomes the set of its five-word shingles (hashed to 64 bits), its
   MinHash bands and a short signature. Texts with equal sets form a class.
2. Classes are shuffled on band hashes. In a bucket, pairs whose signatures
   agree well enough are joined to candidate components; a bucket of many
   classes becomes one component as a whole, so work stays linear in its size.
3. Components are verified on the full sets, in blocks of bounded size: a block
   counts intersections with a matrix product and gives back only each class's
   number of links and a spanning forest of them. All pairs inside a component
   meet, but for those whose sizes alone keep them below the threshold: a large
   component is dealt into classes of size, and only neighbouring ones meet.
4. Links are added up and joined to groups.

Bands and rows are chosen for a target recall at the threshold: with 47 bands
of 8 rows a pair at 0.8 is missed with probability 1.8e-4, and less above.

Defined results: words are runs of letters and digits, lower-cased. A text of
one to four words is its own single shingle. Null and empty texts have no
shingles, are their own class and link to nothing. Texts may have any length.
Repeated rows are copies like others. A row with null doc_id takes part; its
class_id is the smallest id of its group, null if there is none. Further
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.llm.common import query, session, table, whole_rows, with_ids
from fleetspan.session import materialize

NGRAM, THRESHOLD = 5, 0.8
#: Pairs at the threshold are found with this probability at least.
TARGET_RECALL = 0.9998
ROWS = 8
#: Bytes of the signature and the share of them that candidates must have in common (five sigma below the threshold).
SIGNATURE, SIGNATURE_SHARE = 128, 0.62
#: Classes of a bucket up to which its pairs are compared by signature.
SMALL_BUCKET = 64
#: Classes in a block of a component, and shingles in it that it aims at.
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000
#: Columns of the matrix that counts intersections, at a time.
TILE = 8192
#: Bits of the bitmap that keeps texts without candidates out of the second pass.
BITMAP_BITS = 1 << 23
REMEMBERED = 200_000
#: Keys that more than one in so many rows hold are looked up by broadcast: so there are fewer of them than this.
HOT_KEYS = 256
#: Rounds of joining components; they grow with the logarithm of the longest chain.
MAX_ROUNDS = 200


def bands_for(threshold: float, rows: int, recall: float) -> int:
    """Fewest bands of ``rows`` rows that find a pair at the threshold with the wanted probability."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))


class Shingles:
    """Sets of hashed n-grams of words; hashes of words seen before are looked up."""

    def __init__(self, n: int = NGRAM):
        self.n, self.words, self.seen = n, re.compile(r"[^\W_]+").findall, {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes."""
        words = self.words(text.lower()) if text else []
        if not words:
            return np.zeros(0, np.uint64)
        seen = self.seen
        if len(seen) > REMEMBERED:
            seen.clear()
        hashes = []
        for w in words:
            h = seen.get(w)
            if h is None:
                h = seen[w] = xxhash.xxh3_64_intdigest(w)
            hashes.append(h)
        row = np.array(hashes, np.uint64)
        n = min(self.n, len(row))
        with np.errstate(over="ignore"):
            total = np.full(len(row) - n + 1, n, np.uint64)
            for k in range(n):
                total = (total ^ row[k : len(row) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                total ^= total >> np.uint64(32)
        return np.unique(total)


def minima(shingles: np.ndarray, count: int) -> np.ndarray:
    """Minimum of each of ``count`` hash functions over the shingles."""
    draw = np.random.default_rng(7)
    factor = draw.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1)
    offset = draw.integers(0, 1 << 32, count, dtype=np.uint32)
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(count, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 64):
        np.minimum(least, (low[i : i + 64, None] * factor + offset).min(0), out=least)
    return least


def _sketch(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        mix = np.uint64(0xC2B2AE3D27D4EB4F)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for text in batch["text"].to_pylist():
                found = shingles(text)
                keys = sign = key = None
                if len(found):
                    key = xxhash.xxh3_128_digest(found.tobytes())
                    least = minima(found, bands * rows)
                    with np.errstate(over="ignore"):
                        codes = np.arange(1, bands + 1, dtype=np.uint64) * mix
                        for k in range(rows):
                            codes = (codes ^ least[k::rows][:bands].astype(np.uint64)) * mix
                            codes ^= codes >> np.uint64(29)
                    keys, sign = codes.view(np.int64), (least[:SIGNATURE] & np.uint32(255)).astype(np.uint8).tobytes()
                code = None if text is None else int(np.uint64(xxhash.xxh64_intdigest(text)).view(np.int64))
                for column, value in zip(out, (key, len(found), code, keys, sign), strict=True):
                    column.append(value)
            types = (pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "key", "n", "code", "bands", "sign"])

    return run


class Forest:
    """Disjoint sets."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = parent.setdefault(x, x)
        while root != parent[root]:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def join(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


def _agree(least: int):
    """Of rows (band, place, key, sign) sorted by band: edges that join what agrees inside a band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[tuple] = []  # rows of a band that may go on in the next batch

        def edges(rows: list[tuple]) -> pa.RecordBatch:
            band = np.array([r[0] for r in rows], np.int64)
            keys = [r[1] for r in rows]
            sign = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), -1)
            start = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]])) if len(rows) else np.zeros(0, int)
            place = np.arange(len(rows)) - np.repeat(start, np.diff(np.append(start, len(rows))))
            forest, out = Forest(), []
            for lag in range(1, int(place.max(initial=0)) + 1):
                later = np.flatnonzero(place >= lag)
                for i in range(0, len(later), 20_000):
                    at = later[i : i + 20_000]
                    same = at[(sign[at] == sign[at - lag]).sum(1) >= least]
                    out += [(keys[j], keys[j - lag]) for j in same.tolist() if forest.join(keys[j], keys[j - lag])]
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in out], pa.binary()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            rest += zip(*(batch[c].to_pylist() for c in ("band", "key", "sign")), strict=True)
            if len(rest) >= 50_000:
                cut = len(rest)
                while cut and rest[cut - 1][0] == rest[-1][0]:
                    cut -= 1
                yield edges(rest[:cut])
                rest = rest[cut:]
        yield edges(rest)

    return run


def _hot(rows: DataFrame, key: str) -> list:
    """Keys that more than one in HOT_KEYS rows hold."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    least = rows.count() / HOT_KEYS
    return [r[0] for r in counts.where((F.col("n") > least) & (F.col("n") > 1)).collect()]


def _looked_up(rows: DataFrame, key: str, found: DataFrame, hot: list) -> DataFrame:
    """Rows with the columns that ``found`` holds once for each key; rows of hot keys stay where they are."""
    if not hot:
        return rows.join(found, key)
    is_hot = F.col(key).isin([F.lit(k) for k in hot])
    few = F.broadcast(found.where(is_hot))
    return rows.where(~is_hot).join(found.where(~is_hot), key).unionByName(rows.where(is_hot).join(few, key))


def components(edges: DataFrame, label: str) -> DataFrame:
    """node, root: connected components of edges (a, b), root being the smallest node of its component.

    In a round roots are followed one step; then a node and its root both take
    the smallest root of the node's neighbours: chains of any length settle in
    rounds that grow with their logarithm. Each half is written to the shared
    folder; edges are linear in the nodes, so it is a small shuffle. A node with
    many edges and a root of many nodes are looked up without a shuffle.
    """
    both = materialize(
        edges.where(F.col("a") != F.col("b")).select("a", "b").union(edges.select("b", "a")).where(F.col("a") != F.col("b")).distinct(),
        f"{label}-edges",
    )
    busy = _hot(both, "b")
    state = materialize(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("root")).withColumnRenamed("a", "node"), f"{label}-0")
    for i in range(1, MAX_ROUNDS):
        above = state.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = _looked_up(state, "root", above, _hot(state, "root")).select("node", F.col("above").alias("root"), F.col("root").alias("old"))
        jumped = materialize(jumped, f"{label}-{i}-up")
        ends = jumped.select(F.col("node").alias("b"), "root")
        near = _looked_up(both, "b", ends, busy).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        hooks = jumped.select("node", "root").join(near, "node").select(F.explode(F.array("node", "root")).alias("node"), F.col("near").alias("root"))
        hooked = jumped.union(hooks.withColumn("old", F.when(F.lit(False), F.col("root"))))
        hooked = hooked.groupBy("node").agg(F.min("root").alias("root"), F.max("old").alias("old"))
        hooked = materialize(hooked.select("node", "root", (F.col("root") != F.col("old")).alias("moved")), f"{label}-{i}")
        state = hooked.select("node", "root")
        if not hooked.where("moved").limit(1).count():
            return state
    raise RuntimeError("components did not settle")


def dealt(wanted: DataFrame, threshold: float, hot: list) -> DataFrame:
    """Rows (node, root, copies, block, i, j): each class in every pair of blocks that it takes part in.

    ``wanted`` has node, root, copies and n, the size of the set. A component of
    more than a block is dealt by size: sets that reach the threshold are of the
    same class of size or of neighbouring ones.
    """
    # A little wider than the threshold, so that rounding puts no pair two classes apart.
    width = max(-math.log(threshold), 1e-6) * (1 + 1e-6)
    sized = wanted.withColumn("size", F.floor(F.log(F.col("n").cast("double")) / width).cast("int"))
    blocks = lambda rows, shingles: F.greatest(F.ceil(rows / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")
    per_size = sized.groupBy("root", "size").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    # At most a hundred sizes: they are logarithms.
    by_size = F.map_from_entries(F.collect_list(F.struct("size", blocks(F.col("rows"), F.col("shingles")))))
    one = blocks(F.sum("rows"), F.sum("shingles")) <= 1
    per_root = per_size.groupBy("root").agg(F.when(one, F.create_map(F.lit(0), F.lit(1))).otherwise(by_size).alias("blocks"), one.alias("one"))
    members = _looked_up(sized, "root", per_root, hot).withColumn("size", F.when(F.col("one"), 0).otherwise(F.col("size")))

    def number(size: Column, block: Column) -> Column:
        return F.shiftleft(size.cast("long"), 32) + block

    members = members.withColumn("block", number(F.col("size"), F.pmod(F.xxhash64("node"), F.col("blocks")[F.col("size")])))
    near = F.filter(F.array(*[F.col("size") + d for d in (-1, 0, 1)]), lambda k: F.map_contains_key("blocks", k))
    others = F.flatten(F.transform(near, lambda k: F.transform(F.sequence(F.lit(0), F.col("blocks")[k] - 1), lambda b: number(k, b))))
    parts = members.withColumn("other", F.explode(others))
    return parts.select("node", "root", "copies", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def _link(threshold: float):
    """Of rows sorted by (root, i, j): links of each class inside the block, and a spanning forest of them."""

    def verify(rows: list[dict]) -> Iterator[tuple]:
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        sizes = np.array([len(s) for s in sets])
        cross = rows[0]["i"] != rows[0]["j"]
        side = np.array([r["block"] for r in rows])
        values, places = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(places, kind="stable")
        places, owner = places[order], owner[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        for start in range(0, len(values), TILE):
            a, b = np.searchsorted(places, [start, start + TILE])
            tile = np.zeros((len(sets), TILE), np.float32)
            tile[owner[a:b], places[a:b] - start] = 1
            shared += tile @ tile.T
        union = sizes[:, None] + sizes[None, :] - shared
        linked = shared >= threshold * union - 1e-6
        np.fill_diagonal(linked, False)
        if cross:
            linked &= side[:, None] != side[None, :]
        weight = np.array([r["copies"] for r in rows], np.int64)
        classes, docs = linked.sum(1), linked.astype(np.int64) @ weight
        root = np.arange(len(sets))
        while True:
            near = np.minimum(root, np.where(linked, root[None, :], len(root)).min(1, initial=len(root)))
            near = near[near]
            if (near == root).all():
                break
            root = near
        for i in np.flatnonzero(classes).tolist():
            yield rows[i]["key"], rows[root[i]]["key"], int(classes[i]), int(docs[i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            types = (("key", pa.binary()), ("root", pa.binary()), ("classes", pa.int64()), ("docs", pa.int64()))
            made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(types)], [n for n, _ in types])
            out.clear()
            return made

        for _, block in groupby(rows, lambda r: (r["root"], r["i"], r["j"])):
            out += verify(list(block))
            if len(out) > 10_000:
                yield flush()
        yield flush()

    return run


def _sets(bitmap: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bits = Shingles(), np.unpackbits(np.frombuffer(bitmap, np.uint8))
        sent: set[int] = set()  # copies of a text are sent once from a task
        for batch in batches:
            codes, sets = [], []
            for text in batch["text"].to_pylist():
                code = xxhash.xxh64_intdigest(text)
                if bits[code % BITMAP_BITS] and code not in sent:
                    if len(sent) > REMEMBERED:
                        sent.clear()
                    sent.add(code)
                    codes.append(int(np.uint64(code).view(np.int64)))
                    sets.append(shingles(text).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(sets, pa.binary())], ["code", "shingles"])

    return run


def bitmap_of(codes: DataFrame) -> bytes:
    """Bitmap of a column ``code``; at most BITMAP_BITS numbers come to the driver."""
    found = codes.select(F.pmod(F.col("code"), F.lit(BITMAP_BITS)).cast("int").alias("bit")).distinct().toArrow()["bit"].to_numpy()
    bits = np.zeros(BITMAP_BITS, np.uint8)
    bits[found] = 1
    return np.packbits(bits).tobytes()


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``.

    Columns: doc_id; class_id, the smallest doc_id of its group (all that links
    connect); copy_id, the smallest doc_id with the same set; n_links, the number
    of other rows with similarity of ``threshold`` or more; n_texts, of how many
    other sets these are.
    """
    bands = bands_for(threshold, ROWS, recall)
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    rows = materialize(
        texts.mapInArrow(_sketch(bands, ROWS), f"doc_id {id_type}, key binary, n int, code long, bands array<long>, sign binary"),
        "jaccard-rows",
    )
    some = rows.where(F.col("key").isNotNull())
    classes = some.groupBy("key").agg(
        F.min("doc_id").alias("copy_id"), F.count("*").alias("copies"), F.min("n").alias("n"), F.min("code").alias("code"),
        F.min(F.struct("bands", "sign")).alias("s"),
    )
    classes = materialize(classes.select("key", "copy_id", "copies", "n", "code", "s.bands", "s.sign"), "jaccard-classes")

    # Buckets with more than one class.
    banded = classes.select("key", F.explode("bands").alias("band"))
    full = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("key").alias("first")).where(F.col("n") > 1)
    buckets = materialize(banded.join(full, "band"), "jaccard-buckets")
    large = buckets.where(F.col("n") > SMALL_BUCKET).select(F.col("key").alias("a"), F.col("first").alias("b"))
    small = buckets.where(F.col("n") <= SMALL_BUCKET).select("band", "key")
    least = int(SIGNATURE * SIGNATURE_SHARE)
    small = small.join(classes.select("key", "sign"), "key").repartition("band").sortWithinPartitions("band")
    edges = small.mapInArrow(_agree(least), "a binary, b binary").union(large)
    nodes = components(edges, "jaccard-candidates")

    # Sets of the candidates' texts, one text a class.
    wanted = materialize(nodes.join(classes.select(F.col("key").alias("node"), "copies", "n", "code"), "node"), "jaccard-wanted")
    sets = texts.where(F.col("text").isNotNull()).select("text")
    sets = sets.mapInArrow(_sets(bitmap_of(wanted.select("code"))), "code long, shingles binary")
    sets = sets.join(wanted, "code").groupBy("node").agg(F.min("shingles").alias("shingles"))
    parts = dealt(wanted, threshold, _hot(wanted, "root"))
    parts = parts.join(sets, "node").withColumnRenamed("node", "key")
    parts = parts.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    found = materialize(parts.mapInArrow(_link(threshold), "key binary, root binary, classes long, docs long"), "jaccard-links")
    links = found.groupBy("key").agg(F.sum("classes").alias("n_texts"), F.sum("docs").alias("docs"))
    groups = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")), "jaccard-groups")

    # A row for each class, then for each document.
    linked = links.join(groups.withColumnRenamed("node", "key"), "key")
    first = linked.join(classes.select("key", "copy_id"), "key").groupBy("root").agg(F.min("copy_id").alias("class_id"))
    linked = _looked_up(linked, "root", first, _hot(groups, "root")).drop("root")
    named = classes.select("key", "copy_id", "copies").join(linked, "key", "left").select(
        "key",
        "copy_id",
        F.coalesce("class_id", "copy_id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"),
        F.coalesce("n_texts", F.lit(0)).alias("n_texts"),
    )
    # The copies are counted already; rows without a set have nothing to look up.
    many = (F.col("copies") > some.count() / HOT_KEYS) & (F.col("copies") > 1)
    copied = [r["key"] for r in classes.where(many).select("key").collect()]
    found = _looked_up(some.select("doc_id", "key"), "key", named, copied).select("doc_id", "class_id", "copy_id", "n_links", "n_texts")
    own = F.col("doc_id")
    none = rows.where(F.col("key").isNull()).select("doc_id", own.alias("class_id"), own.alias("copy_id"), F.lit(0).alias("n_links"), F.lit(0).alias("n_texts"))
    return found.union(none).withColumns({c: F.col(c).cast("long") for c in ("n_links", "n_texts")})


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group the document with the smallest id.

    Rows with the same id are one document. Rows without an id are documents of their own, which others go before.
    """
    session(spark)
    rows = with_ids(whole_rows(docs, "doc_id", "text"), "jaccard-named")
    kept = materialize(join(rows).where(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("_kept")), "jaccard-kept")
    found = rows.join(kept.distinct(), F.col("doc_id") == F.col("_kept"), "left_semi")
    if kept.groupBy("_kept").count().where("count > 1").limit(1).count():  # rows repeated with their id
        found = found.dropDuplicates(["doc_id"])
    return found.select("_row.*")


@query()
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
