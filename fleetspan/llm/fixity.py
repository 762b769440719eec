"""Merkle fixity audit of WARC replicas.

Every record of a file has an offset and a hash. Records are grouped by ordered
offset ranges; the hash of a range is the hash of its records' hashes in order,
the hash of a wider range that of its ranges', up to a root for each file. The
audit compares roots. Below roots that differ it goes down: on each level only
the children of differing ranges are compared, until single records are left.

Payloads are hashed where they are read and never shuffled. A node has at most
WIDTH offsets or FANOUT children (a root two ranges at most, and one for a null
offset): the number of levels comes from the largest offset of both replicas,
so no group grows with the data.

Defined results: a null payload is a record of its own kind, different from an
empty one. Records with the same file and offset are one leaf, hashed from
their number and the sum of their hashes, so repeated rows and ties do not
depend on order; it is ``extra`` or ``missing`` by the number of records, else
``changed``. Null files and null offsets count as one file and one offset.
Payloads may have any length. Further columns are ignored. An empty replica
misses all records; two empty ones are equal.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.llm.common import query, table
from fleetspan.session import materialize

#: Offsets of the lowest ranges, and ranges that make one of the next level.
WIDTH, FANOUT = 16, 16
#: Records of a file of the registered query.
PER_FILE = 4096
#: Stands for a null file or offset.
NONE = -(2**62)


def leaves(records: DataFrame, side: int) -> DataFrame:
    """side, file, node (the offset), n and hash of the records at each offset."""
    body = F.col("payload").cast("binary")
    digest = F.sha2(F.concat(F.when(body.isNull(), F.lit("n")).otherwise(F.lit("v")).cast("binary"), F.coalesce(body, F.lit(b""))), 256)
    words = [F.conv(F.substring("digest", 1 + 8 * i, 8), 16, 10).cast("long").alias(f"w{i}") for i in range(8)]
    none = F.lit(NONE).cast("long")
    rows = records.select(
        F.coalesce(F.col("file").cast("long"), none).alias("file"), F.coalesce(F.col("offset").cast("long"), none).alias("node"), digest.alias("digest")
    ).select("file", "node", *words)
    found = rows.groupBy("file", "node").agg(F.count("*").alias("n"), *(F.sum(f"w{i}").alias(f"w{i}") for i in range(8)))
    whole = F.sha2(F.concat_ws("|", "n", *(f"w{i}" for i in range(8))), 256)
    return found.select(F.lit(side).alias("side"), "file", "node", "n", whole.alias("hash"))


def levels_of(low: DataFrame) -> int:
    """Levels of ranges, so that the highest has one range from offset 0 on, and one below 0."""
    known = F.when(F.col("node") != NONE, F.col("node"))
    low_end, high_end = low.agg(F.min(known), F.max(known)).first()
    # Ranges at either side of 0 that the farthest offsets lie in.
    ranges, levels = max(high_end or 0, -1 - (low_end or 0), 0) // WIDTH, 1
    while ranges:
        ranges, levels = ranges // FANOUT, levels + 1
    return levels


def tree(low: DataFrame, levels: int | None = None) -> list[DataFrame]:
    """Levels from the records up to the roots: side, file, node, parent, hash; written to the shared folder."""
    # The null offset stays a node of its own on every level.
    up = lambda step: F.when(F.col("node") == NONE, F.col("node")).otherwise(F.expr(f"(node - pmod(node, {step}L)) div {step}L"))
    out = [materialize(low.withColumn("parent", up(WIDTH)), "fixity-0")]
    levels = levels or levels_of(out[0])
    for level in range(1, levels + 2):
        ordered = F.array_sort(F.collect_list(F.struct("node", "hash")))
        joined = F.array_join(F.transform(ordered, lambda c: F.concat_ws(":", c["node"], c["hash"])), "|")
        nodes = out[-1].groupBy("side", "file", F.col("parent").alias("node")).agg(F.sha2(joined, 256).alias("hash"))
        # The top ranges of a file have the root above them.
        parent = up(FANOUT) if level < levels else F.lit(0).cast("long")
        out.append(materialize(nodes.withColumn("parent", parent), f"fixity-{level}"))
    return out


def differing(level: DataFrame, *more: str) -> DataFrame:
    """file, node of a level whose hashes are not the same in both replicas."""
    of = lambda c, side: F.max(F.when(F.col("side") == side, F.col(c)))
    kept = [of(c, s).alias(f"{c}_{s}") for c in more for s in (0, 1)]
    found = level.groupBy("file", "node").agg(of("hash", 0).alias("h0"), of("hash", 1).alias("h1"), *kept)
    return found.where(~F.col("h0").eqNullSafe(F.col("h1"))).drop("h0", "h1")


def audit(replica: DataFrame, other: DataFrame, levels: int | None = None) -> DataFrame:
    """Records of ``replica`` that ``other`` does not hold alike.

    Both: file, offset, payload. Result: file, offset, kind (``missing``,
    ``extra`` or ``changed``, as seen in ``other``), n_records and n_other.
    ``levels`` of ranges below the roots are as many as the offsets need, unless given.
    """
    low = reduce(DataFrame.union, (leaves(r, side) for side, r in enumerate((replica, other))))
    whole = tree(low, levels)
    bad = differing(whole[-1])
    for i in range(len(whole) - 2, -1, -1):
        above = materialize(bad.select("file", F.col("node").alias("parent")), f"fixity-differing-{i}")
        below = whole[i].join(above, ["file", "parent"], "left_semi")
        bad = differing(below, "n") if i == 0 else differing(below)
    n, m = F.coalesce("n_0", F.lit(0)), F.coalesce("n_1", F.lit(0))
    kind = F.when(m < n, "missing").when(m > n, "extra").otherwise("changed")
    given = lambda c: F.when(F.col(c) != NONE, F.col(c))
    return bad.select(given("file").alias("file"), given("node").alias("offset"), kind.alias("kind"), n.alias("n_records"), m.alias("n_other"))


def records(pages: DataFrame) -> DataFrame:
    """Pages as records of WARC files: file, offset, payload."""
    head = F.concat(F.lit("WARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")), F.lit("\r\n\r\n"))
    return pages.select(
        F.floor(F.col("page_id") / PER_FILE).cast("long").alias("file"),
        F.col("page_id").alias("offset"),
        F.when(F.col("html").isNotNull(), F.concat(head, F.col("html"))).alias("payload"),
    )


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with known damage: some pages cut short, some lost, some held twice."""
    key = F.col("page_id")
    cut = F.when(key % 97 == 13, F.expr("substring(html, 1, length(html) - 1)")).otherwise(F.col("html"))
    kept = pages.where((key % 101 != 7) | key.isNull()).withColumn("html", cut)
    return kept.union(kept.where(key % 103 == 5))


SQL = f"""
with a as (
  select page_id // {PER_FILE} as file, page_id as "offset",
    case when html is not null then coalesce(url, '') || chr(10) || html end as payload from pages
), b as (
  select page_id // {PER_FILE} as file, page_id as "offset",
    case when html is not null then coalesce(url, '') || chr(10)
      || case when page_id % 97 = 13 then substring(html, 1, length(html) - 1) else html end end as payload
  from pages, range(2) as copies(copy)
  where (page_id % 101 <> 7 or page_id is null) and (copy = 0 or page_id % 103 = 5)
), x as (
  select file, "offset", count(*) as n, list_sort(list(coalesce('v' || payload, 'n'))) as held from a group by all
), y as (
  select file, "offset", count(*) as n, list_sort(list(coalesce('v' || payload, 'n'))) as held from b group by all
)
select coalesce(x.file, y.file) as file, coalesce(x."offset", y."offset") as "offset",
  case when coalesce(y.n, 0) < coalesce(x.n, 0) then 'missing' when coalesce(y.n, 0) > coalesce(x.n, 0) then 'extra'
    else 'changed' end as kind, coalesce(x.n, 0) as n_records, coalesce(y.n, 0) as n_other
from x full join y on x."offset" is not distinct from y."offset" and x.file is not distinct from y.file
where x.held is distinct from y.held
"""


@query(SQL)
def op5_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return audit(records(pages), records(damaged(pages)))
