"""Extraction from captured documents, as Column expressions.

Every function takes a body column and returns a STRING column that is null
where nothing was found. None of them leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType


def count_groups(pattern: str) -> int:
    """Number of capturing groups of a Java regular expression."""
    groups, in_class, i = 0, 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            if pattern[i + 1 : i + 2] == "Q":
                end = pattern.find("\\E", i + 2)
                i = len(pattern) if end < 0 else end
            i += 2
            continue
        if c == "[":
            in_class += 1
        elif c == "]" and in_class:
            in_class -= 1
        elif c == "(" and not in_class:
            rest = pattern[i + 1 : i + 4]
            named = rest.startswith("?<") and rest[2:3] not in ("=", "!")
            if not rest.startswith("?") or named:
                groups += 1
        i += 1
    return groups


def extract_regex(body: Column, pattern: str) -> Column:
    """First match anywhere: group 1 if the pattern has groups, else the whole match."""
    if count_groups(pattern) == 0:
        return F.regexp_substr(body, F.lit(pattern))
    # A found group is one pass; the second test only tells an empty group from no match.
    found = F.nullif(F.regexp_extract(body, pattern, 1), F.lit(""))
    return F.coalesce(found, F.when(body.rlike(pattern), F.lit("")))


# --- paths into JSON documents ----------------------------------------------
#
# A document is read with a schema made from what is asked of it: objects are
# structs of the asked keys, everything else is kept as it is written. So the
# last of repeated keys counts, and a document that is not whole gives nothing.
# A numeric step may be a list index or a key, which no schema can say: such a
# value is kept as text and read again, alone, as the one or the other.

#: No key of a document, so that no asked key is taken for the column of broken records.
_READ = {"columnNameOfCorruptRecord": "\x00"}


def _object(text: Column, schema: StructType) -> Column:
    return F.from_json(F.when(text.rlike(r"^\s*\{"), text), schema, _READ)


def _list(text: Column, element: DataType) -> Column:
    return F.from_json(F.when(text.rlike(r"^\s*\["), text), ArrayType(element), _READ)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` that evaluates ``value`` once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _at(body: Column, steps: list[str], lists: bool) -> Column:
    """Value below the steps; names in a row are read at once."""
    if not steps:
        return body
    if lists and steps[0].isdigit():
        step, rest = steps[0], steps[1:]
        key = StructType([StructField(step, StringType())])
        return _at(
            _let(body, lambda raw: F.coalesce(F.get(_list(raw, StringType()), F.lit(int(step))), _object(raw, key).getField(step))),
            rest, lists,
        )
    run = next((i for i, s in enumerate(steps) if lists and s.isdigit()), len(steps))
    schema: DataType = StringType()
    for step in reversed(steps[:run]):
        schema = StructType([StructField(step, schema)])
    value = _object(body, schema)
    for step in steps[:run]:
        value = value.getField(step)
    return _at(value, steps[run:], lists)


def _tree_steps(path: str) -> list[str] | None:
    """Steps of a path whose first character is the separator; None for no path."""
    if not path:
        return None
    steps = path[1:].split(path[0])
    while steps and steps[-1] == "":
        steps.pop()
    return steps


def _whole(body: Column) -> Column:
    return F.when(body.rlike(r"^\s*\{"), body)


def json_path(body: Column, path: str) -> Column:
    """Value at ``path`` whose first character is the separator, as in ``/body/0``.

    The separator is literal, and so are the keys. A missing step, or one below
    a scalar, gives null. For several paths of a document use ``with_paths``.
    """
    steps = _tree_steps(path)
    if steps is None:
        return F.lit(None).cast("string")
    return _at(body, steps, lists=True) if steps else _whole(body)


def map_path(body: Column, dotted: str) -> Column:
    """Value at ``a.b.c`` through nested maps; null as soon as a step is not a map."""
    return _at(body, dotted.split("."), lists=False)


@dataclass
class _Node:
    """What is asked at a place of a document and below it."""

    names: list[str] = field(default_factory=list)
    below: dict[str, _Node] = field(default_factory=dict)

    def add(self, steps: list[str], name: str) -> None:
        node = self
        for step in steps:
            node = node.below.setdefault(step, _Node())
        node.names.append(name)

    def merged(self, other: _Node) -> _Node:
        """What is asked by either."""
        below = dict(self.below)
        for step, node in other.below.items():
            below[step] = below[step].merged(node) if step in below else node
        return _Node(self.names + other.names, below)

    def schema(self, lists: bool) -> DataType:
        """A struct where only keys are asked, else text, to be read on."""
        steps = list(self.below)
        # Spark finds fields without regard to case.
        distinct = len({s.lower() for s in steps}) == len(steps)
        if not steps or self.names or not distinct or (lists and any(s.isdigit() for s in steps)):
            return StringType()
        return StructType([StructField(s, n.schema(lists)) for s, n in self.below.items()])


def _apart(steps: Iterable[str]) -> list[list[str]]:
    """Steps in groups without two that differ in case only."""
    groups: list[dict[str, str]] = []
    for step in steps:
        free = next((g for g in groups if step.lower() not in g), None)
        if free is None:
            groups.append(free := {})
        free[step.lower()] = step
    return [list(g.values()) for g in groups]


class _Reader:
    """Adds the columns that a tree of paths needs; ``values`` holds a value's candidates by name.

    A text that is parsed gets a column of its own, which Spark does not copy
    into the expressions that use it: so it is parsed once for all of them.
    """

    def __init__(self, df: DataFrame, lists: bool):
        self.df, self.lists = df, lists
        self.made: list[str] = []
        self.values: dict[str, list[Column]] = {}
        self.waiting: list[tuple[Column, _Node]] = []

    def parsed(self, columns: dict[str, Column], expression: Column) -> Column:
        self.made.append(f"_json_{len(self.made)}")
        columns[self.made[-1]] = expression
        return F.col(self.made[-1])

    def take(self, value: Column, kind: DataType, node: _Node) -> None:
        if isinstance(kind, StructType):
            for step, child in node.below.items():
                self.take(value.getField(step), kind[step].dataType, child)
            return
        for name in node.names:
            self.values.setdefault(name, []).append(value)
        if node.below:
            self.waiting.append((value, node))

    def read(self, body: Column, root: _Node) -> None:
        self.waiting.append((body, root))
        while self.waiting:
            texts, self.waiting = self.waiting, []
            columns: dict[str, Column] = {}
            found: list[tuple[Column, DataType, _Node]] = []
            for text, node in texts:
                indexed = {s: n for s, n in node.below.items() if self.lists and s.isdigit()}
                element: DataType = StringType()
                if indexed:
                    element = reduce(_Node.merged, indexed.values()).schema(self.lists)
                    items = self.parsed(columns, _list(text, element))
                    found += [(F.get(items, F.lit(int(s))), element, n) for s, n in indexed.items()]
                for group in _apart(node.below):
                    fields = [StructField(s, StringType() if s in indexed else node.below[s].schema(self.lists)) for s in group]
                    keys = self.parsed(columns, _object(text, StructType(fields)))
                    found += [(keys.getField(f.name), f.dataType, node.below[f.name]) for f in fields]
            self.df = self.df.withColumns(columns)
            for value in found:
                self.take(*value)


def with_paths(df: DataFrame, body: str, paths: dict[str, str], fmt: str = "jsonTree") -> DataFrame:
    """Add a column for each path (name -> path), the body being parsed once for all.

    ``fmt`` says how paths are written: ``jsonTree`` as in ``json_path``, ``map``
    as in ``map_path``, ``grouped`` as in ``grouped_value``.
    """
    reader = _Reader(df, lists=fmt == "jsonTree")
    source = F.col(body)
    nothing = F.lit(None).cast("string")
    values: dict[str, Column] = {}
    if fmt == "grouped":
        parts = {name: path.split(".", 2) for name, path in paths.items()}
        columns: dict[str, Column] = {}
        scopes: dict[str, Column] = {}
        for group in _apart(dict.fromkeys(p[0] for p in parts.values() if len(p) == 3)):
            document = reader.parsed(columns, _object(source, StructType([StructField(s, _GROUPS) for s in group])))
            scopes |= {s: document.getField(s) for s in group}
        reader.df = df.withColumns(columns) if columns else df
        values = {n: _in_scope(scopes[p[0]], p[1], p[2]) if len(p) == 3 else nothing for n, p in parts.items()}
    elif fmt in ("jsonTree", "map"):
        root = _Node()
        for name, path in paths.items():
            steps = _tree_steps(path) if fmt == "jsonTree" else path.split(".")
            if steps:
                root.add(steps, name)
            else:
                values[name] = nothing if steps is None else _whole(source)
        if root.below:
            reader.read(source, root)
        values |= {n: c[0] if len(c) == 1 else F.coalesce(*c) for n, c in reader.values.items()}
    else:
        raise ValueError(f"unknown kind of paths {fmt}")
    return reader.df.withColumns({n: values[n] for n in paths}).drop(*reader.made)


def well_formed(body: Column) -> Column:
    """The body where it is well-formed XML, else null: XPath would fail the job on other text."""
    broken = F.from_xml(body, "_corrupt_record STRING", {"mode": "PERMISSIVE"})["_corrupt_record"]
    return F.when(body.isNotNull() & broken.isNull(), body)


def xpath_value(xml: Column, expression: str) -> Column:
    """String value of an XPath expression over well-formed XML; null for no match."""
    return F.nullif(F.xpath_string(xml, F.lit(expression)), F.lit(""))


def extract_xpath(body: Column, expression: str) -> Column:
    """String value of an XPath expression; null for no match or malformed XML."""
    return xpath_value(well_formed(body), expression)


def extract_header(headers: Column, name: str) -> Column:
    """First value of a response header, names compared without case."""
    same = F.map_filter(headers, lambda k, _: F.lower(k) == name.lower())
    return F.try_element_at(F.try_element_at(F.map_values(same), F.lit(1)), F.lit(1))


def json_size(text: Column) -> Column:
    """Number of keys of a JSON object held as text; -1 when it is not one."""
    return F.coalesce(F.size(F.json_object_keys(text)), F.lit(-1))


def count_or_value(metric: str, value: Column) -> Column:
    """Map size for a metric named ``...Count``, else the value itself."""
    return json_size(value).cast("string") if metric.endswith("Count") else value


def window_id(value: Column) -> Column:
    """Low 16 bits of a 64-bit window number."""
    return value.try_cast("bigint").bitwiseAND(F.lit(0xFFFF).cast("bigint"))


def truncate(text: Column, limit: int, ellipsis: str = "") -> Column:
    """At most ``limit`` characters; ``ellipsis`` is appended only where text was cut."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(ellipsis))).otherwise(text)


# Limits for captured output, logged bodies and descriptions.
OUTPUT_LIMIT = 1024
LOG_LIMIT = 100
DESCRIPTION_LIMIT = 1000


def output_text(text: Column) -> Column:
    return truncate(text, OUTPUT_LIMIT)


def log_text(text: Column) -> Column:
    return truncate(text, LOG_LIMIT, "...")


def description_text(text: Column) -> Column:
    return truncate(text, DESCRIPTION_LIMIT)


# --- extractors by document format -----------------------------------------

Extractor = Callable[[Column, str], Column]
Wrapper = Callable[[str, Column], Column]

_EXTRACTORS: dict[str, Extractor] = {}


def register_extractor(name: str, extractor: Extractor) -> None:
    """Make ``extractor(body, metric)`` available as document format ``name``."""
    _EXTRACTORS[name] = extractor


def extractor(name: str) -> Extractor:
    return _EXTRACTORS[name]


@dataclass(frozen=True)
class Wrapped:
    """An extractor whose value goes through ``wrapper(metric, value)`` functions."""

    base: str | Extractor
    wrappers: tuple[Wrapper, ...]

    def finish(self, metric: str, value: Column) -> Column:
        for wrapper in self.wrappers:
            value = wrapper(metric, value)
        return value

    def __call__(self, body: Column, metric: str) -> Column:
        inner = _EXTRACTORS[self.base] if isinstance(self.base, str) else self.base
        return self.finish(metric, inner(body, metric))


def wrapped(base: str | Extractor, *wrappers: Wrapper) -> Wrapped:
    """An extractor whose value goes through ``wrapper(metric, value)`` functions."""
    return Wrapped(base, wrappers)


def low_bits_of_window_ids(metric: str, value: Column) -> Column:
    """Wrapper: metrics named ``...WindowId`` keep their low 16 bits."""
    return window_id(value).cast("string") if metric.endswith("WindowId") else value


_ENTRIES = ArrayType(StructType([StructField("name", StringType()), StructField("value", StringType())]))
_GROUPS = ArrayType(StructType([StructField("group", StringType()), StructField("data", _ENTRIES)]))


def _in_scope(groups: Column, group: str, name: str) -> Column:
    """Value of the first entry of that name in the groups so called."""
    own = F.filter(groups, lambda g: (g["group"] == group) & g["data"].isNotNull())
    data = F.flatten(F.transform(own, lambda g: g["data"]))
    return F.try_element_at(F.filter(data, lambda d: d["name"] == name), F.lit(1))["value"]


def grouped_value(body: Column, metric: str) -> Column:
    """Value of ``scope.group.name`` in a document of scopes, each a list of groups with a data list.

    The name keeps its own dots.
    """
    parts = metric.split(".", 2)
    if len(parts) < 3:
        return F.lit(None).cast("string")
    scope, group, name = parts
    return _in_scope(_object(body, StructType([StructField(scope, _GROUPS)])).getField(scope), group, name)


def _no_extractor(body: Column, metric: str) -> Column:
    return F.lit(None).cast("string")


register_extractor("none", _no_extractor)
register_extractor("regex", extract_regex)
register_extractor("jsonTree", json_path)
register_extractor("map", map_path)
register_extractor("grouped", grouped_value)
register_extractor("xml", extract_xpath)

# Names of the metrics every response has.
BUILT_IN_METRICS = {
    "responseTime": "elapsed_ms",
    "responseSize": "content_length",
    "lastModified": "last_modified",
}


def response_metric(df: DataFrame, metric: str, fmt: str | Extractor) -> Column:
    """One metric of a captured response: built-in, ``#header`` or extracted from the body."""
    if metric in BUILT_IN_METRICS:
        return df[BUILT_IN_METRICS[metric]].cast("string")
    if metric.startswith("#"):
        return extract_header(df["headers"], metric[1:])
    build = _EXTRACTORS[fmt] if isinstance(fmt, str) else fmt
    return build(df["body"], metric)


#: Formats whose documents are parsed once for all metrics.
_BY_PATH = ("jsonTree", "map", "grouped")


def extract_metrics(df: DataFrame, metrics: list[str], fmt: str | Extractor, keep: list[str]) -> DataFrame:
    """Long rows (keep..., metric, value): each body is read once for all its metrics."""
    base, layers = fmt, []
    while isinstance(base, Wrapped):
        layers.append(base)
        base = base.base

    def finish(metric: str, value: Column) -> Column:
        for layer in reversed(layers):
            value = layer.finish(metric, value)
        return value

    if base in _BY_PATH:
        asked = [m for m in metrics if m not in BUILT_IN_METRICS and not m.startswith("#")]
        names = {m: f"_value_{i}" for i, m in enumerate(asked)}
        df = with_paths(df, "body", {names[m]: m for m in asked}, base)
        values = [finish(m, F.col(names[m])) if m in names else response_metric(df, m, fmt) for m in metrics]
    else:
        if base == "xml":
            # Checked once for all expressions, not once for each.
            df = df.withColumn("body", well_formed(F.col("body")))
            read = wrapped(xpath_value, finish)
        else:
            read = fmt
        values = [response_metric(df, m, read) for m in metrics]
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in zip(metrics, values, strict=True)])
    return (
        df.select(*keep, F.explode(pairs).alias("_m"))
        .select(*keep, "_m.metric", "_m.value")
        .filter(F.col("value").isNotNull())
    )


def explain_extract(
    df: DataFrame, fmt: str | Extractor, metric: str = "", request: Column | None = None, accept: Column | None = None
) -> DataFrame:
    """What an extraction sees: success, code, url, request and the value or the full body."""
    ok = F.lit(True) if accept is None else F.coalesce(accept, F.lit(False))
    value = F.coalesce(response_metric(df, metric, fmt), F.lit("")) if metric else df["body"]
    return df.select(
        ok.alias("success"),
        F.col("code").alias("response_code"),
        F.col("resource_key").alias("url"),
        (F.lit("") if request is None else request).alias("request"),
        value.alias("response"),
    )
