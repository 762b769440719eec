"""Tables, pairs and links in HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How the pages are laid out.
HEADER_TABLE = r"<table[^>]+>\s*<tr>(.*)</tr>\s*<tr>(.*)</tr>\s*</table>"
#: Possessive: a run of any length is taken in a loop, not by a call for every tag.
TAG_RUN = r"(?:\s*+</?\w++[^>]*+>\s*+)++"
PAIR_ROW = r"<tr><td>([\w\s]+)</td><td>([\d.]+)</td>"
TOTAL_LINE = r"Total.*?servers\D*(\d+).*?requests\D*(\d+).*?regions\D*(\d+)"
QUEUE_LINK = r'"jobqueue_details\.jsp\?queueName=([^"]*)"'
QUEUE_COLUMNS = ["map_total", "maps_completed", "reduce_total", "reduces_completed"]


def header_values(html: Column) -> Column:
    """ARRAY<STRUCT(key, value)>: a table's header row zipped with its value row, empty cells skipped."""
    heads = F.split(F.regexp_extract(html, HEADER_TABLE, 1), TAG_RUN)
    cells = F.split(F.regexp_extract(html, HEADER_TABLE, 2), TAG_RUN)
    pairs = F.arrays_zip(heads.alias("key"), cells.alias("text"))
    typed = F.transform(
        pairs, lambda p: F.struct(p["key"].alias("key"), p["text"].try_cast("double").alias("value"))
    )
    return F.when(html.rlike(HEADER_TABLE), F.filter(typed, lambda p: (p["key"] != "") & p["value"].isNotNull()))


def cell_pairs(html: Column, pattern: str = PAIR_ROW) -> Column:
    """ARRAY<STRUCT(key, text)> of every match of a two-group pattern."""
    return F.arrays_zip(
        F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("key"),
        F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("text"),
    )


def server_totals(html: Column) -> Column:
    """STRUCT(servers, requests, regions, rserver) of the totals line; null without one."""
    def part(group: int) -> Column:
        return F.regexp_extract(html, TOTAL_LINE, group).try_cast("double")

    return F.when(
        html.rlike(TOTAL_LINE),
        F.struct(
            part(1).alias("servers"),
            part(2).alias("requests"),
            part(3).alias("regions"),
            F.try_divide(part(3), part(1)).alias("rserver"),
        ),
    )


def page_pairs(df: DataFrame, html: str, keep: list[str], pattern: str = PAIR_ROW) -> DataFrame:
    """Rows (keep..., key, value) of the page's two-cell rows and of its totals line."""
    totals = server_totals(F.col(html))
    total_rows = F.when(
        totals.isNotNull(),
        F.array(
            *[
                F.struct(F.lit(name).alias("key"), totals[name].cast("string").alias("text"))
                for name in ("servers", "requests", "regions", "rserver")
            ]
        ),
    ).otherwise(F.array().cast("array<struct<key: string, text: string>>"))
    return (
        df.select(*keep, F.explode(F.concat(cell_pairs(F.col(html), pattern), total_rows)).alias("_p"))
        .select(*keep, F.col("_p.key").alias("key"), F.col("_p.text").try_cast("double").alias("value"))
        .filter(F.col("value").isNotNull())
    )


# A cell counts when its text is an integer; the parts of a page that row statistics look at.
INTEGER_CELL = r"(?i)<td\b[^>]*>\s*([0-9]+)\s*(?=<|\z)"
ROW_END = r"(?i)</?tr\b|</table\b"
ROW_PARTS = r"(?i)</?table\b|</?tr\b|<td\b[^>]*>\s*[0-9]+\s*(?=<|\z)"
TABLE_IN_TABLE = r"(?i)<table\b[^<]*+(?:<(?!/?table\b)[^<]*+)*+<table\b"


def row_sums(html: Column, width: int) -> Column:
    """STRUCT(sums, rows) over the table rows with exactly ``width`` integer cells.

    A row of a table inside a cell belongs to the row around it. Such pages are
    folded part by part; all others are cut at their row tags.
    """
    return F.when(html.rlike(TABLE_IN_TABLE), _nested_row_sums(html, width)).otherwise(_flat_row_sums(html, width))


def _flat_row_sums(html: Column, width: int) -> Column:
    # The text before a row tag keeps the bracket of its last cell's end.
    texts = F.transform(F.split(html, ROW_END), lambda r: F.regexp_extract_all(F.concat(r, F.lit("<")), F.lit(INTEGER_CELL), F.lit(1)))
    full = F.filter(texts, lambda cells: F.size(cells) == width)

    def sums(rows: Column) -> Column:
        def column(i: int) -> Column:
            return F.aggregate(rows, F.lit(0).cast("bigint"), lambda total, cells: total + cells[i].try_cast("bigint"))

        return F.struct(F.array(*[column(i) for i in range(width)]).alias("sums"), F.size(rows).cast("bigint").alias("rows"))

    # The one-element list binds the rows, so that they are found once.
    return F.transform(F.array(full), sums)[0]


def _nested_row_sums(html: Column, width: int) -> Column:
    parts = F.regexp_extract_all(html, F.lit(ROW_PARTS), F.lit(0))

    def state(depth, cells, sums, rows) -> Column:
        return F.struct(depth.alias("depth"), cells.alias("cells"), sums.alias("sums"), rows.alias("rows"))

    def closed(s: Column) -> Column:
        full = F.size(s["cells"]) == width
        return state(
            s["depth"],
            F.array().cast("array<bigint>"),
            F.when(full, F.zip_with(s["sums"], s["cells"], lambda a, b: a + b)).otherwise(s["sums"]),
            F.when(full, s["rows"] + 1).otherwise(s["rows"]),
        )

    def step(s: Column, part: Column) -> Column:
        tag = F.lower(F.substring(part, 1, 4))
        number = F.regexp_extract(part, r"([0-9]+)\s*$", 1).try_cast("bigint")
        # One cell too many is enough to know that the row does not count.
        with_cell = state(
            s["depth"], F.when(F.size(s["cells"]) > width, s["cells"]).otherwise(F.array_append(s["cells"], number)), s["sums"], s["rows"]
        )
        opens = tag == "<tab"
        closes = tag == "</ta"
        move = F.when(opens, 1).when(closes, -1).otherwise(0)
        at = state((s["depth"] + move).cast("int"), s["cells"], s["sums"], s["rows"])
        ends_row = F.when(closes, s["depth"] <= 1).otherwise(~opens & (s["depth"] <= 1))
        return F.when(F.startswith(tag, F.lit("<td")), with_cell).when(ends_row, closed(at)).otherwise(at)

    nothing = state(F.lit(0), F.array().cast("array<bigint>"), F.array_repeat(F.lit(0).cast("bigint"), width), F.lit(0).cast("bigint"))
    return F.aggregate(parts, nothing, step, lambda s: F.struct(closed(s)["sums"].alias("sums"), closed(s)["rows"].alias("rows")))


def queue_stats(df: DataFrame, html: str, keep: list[str], columns: list[str] | None = None) -> DataFrame:
    """Per key: sums over the table rows with exactly one integer cell per column, and their number."""
    columns = columns or QUEUE_COLUMNS
    return (
        df.select(*keep, row_sums(F.col(html), len(columns)).alias("_s"))
        .groupBy(*keep)
        .agg(
            *[F.sum(F.col("_s.sums")[i]).alias(name) for i, name in enumerate(columns)],
            F.sum("_s.rows").alias("rows"),
        )
    )


def harvest_links(df: DataFrame, html: str, pattern: str = QUEUE_LINK, out: str = "link") -> DataFrame:
    """Distinct first groups of a link pattern over all pages."""
    return df.select(F.explode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))).alias(out)).distinct()
