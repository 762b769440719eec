"""Queries that extract and type values from captured documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.functions import coerce as C
from fleetspan.functions import extract as X
from fleetspan.functions import html as H
from fleetspan.functions import replica as RP
from fleetspan.functions import text as T
from fleetspan.functions import urls as U
from fleetspan.operators.digest import digest_errors, json_digest, numeric_digest
from fleetspan.operators.events import ordered_text
from fleetspan.operators.jobs import coordinator_times
from fleetspan.operators.snmp import decode_codes
from fleetspan.operators import commands as CM
from fleetspan.operators import metadata as M
from fleetspan.operators import report as R
from fleetspan.plans.registry import Tables, query
from fleetspan.plans import inputs as I
from fleetspan.session import local_table


@query("S1 S11 E6 E7 X1", f"""
with {I.RESPONSES_SQL}
select page_id, 'responseTime' as metric, cast(elapsed_ms as varchar) as value from responses
union all select page_id, 'responseSize', cast(content_length as varchar) from responses
union all select page_id, 'lastModified', cast(last_modified as varchar) from responses
union all select page_id, '#x-head', cast(page_id * 3 as varchar) from responses
union all select page_id, '#server', 'srv/' || id_text from responses
union all select page_id, '<title>([^<]*)', regexp_extract(body, '<title>([^<]*)', 1) from responses
  where regexp_matches(body, '<title>([^<]*)')
""")
def response_metrics(t: Tables) -> DataFrame:
    metrics = ["responseTime", "responseSize", "lastModified", "#x-head", "#server", "<title>([^<]*)"]
    return X.extract_metrics(I.responses(t), metrics, "regex", ["page_id"])


@query("E1 F2 X1", r"""
select page_id, regexp_extract(html, '<title>([^<]*)', 1) as title,
  nullif(regexp_extract(url, '\d+', 0), '') as number,
  case when regexp_matches(html, 'zucchini') then 'zucchini' end as absent
from pages where regexp_matches(html, '<title>')
""")
def regex_extract_title(t: Tables) -> DataFrame:
    return t.pages.filter(F.col("html").rlike("<title>")).select(
        "page_id",
        X.extract_regex(F.col("html"), "<title>([^<]*)").alias("title"),
        X.extract_regex(F.col("url"), r"\d+").alias("number"),
        X.extract_regex(F.col("html"), "zucchini").alias("absent"),
    )


@query("E2 S9 X5", """
select event_id, 'k' as key, props->>'$.k' as value, try_cast(props->>'$.k' as double) as number from events
""")
def json_digest_long(t: Tables) -> DataFrame:
    return json_digest(t.events, "props", ["event_id"])


def _nested(t: Tables) -> DataFrame:
    e = t.events
    document = F.struct(
        F.col("event_id").alias("id"),
        F.struct(
            F.col("event_type").alias("kind"), F.lit("").alias("empty"), F.lit(True).alias("flag"),
            F.array(
                F.struct(F.col("value").alias("amount"), F.lit(None).cast("bigint").alias("owner")),
                F.struct(F.lit(None).cast("double").alias("amount"), F.col("user_id").alias("owner")),
            ).alias("parts"),
        ).alias("meta"),
        F.array(F.lit(1), F.lit(2)).alias("bare"),
        F.struct(F.struct((F.col("event_id") + 1).alias("id")).alias("deep")).alias("again"),
    )
    return e.select("event_id", F.to_json(document).alias("body"))


def _mixed(t: Tables) -> DataFrame:
    body = F.col("body")
    # Some are broken, some repeat a key, some hold an integer beyond 64 bits, some are a list of a document.
    kind = F.col("event_id") % 5
    odd = (
        F.when(kind == 1, F.concat(body, F.lit(" }")))
        .when(kind == 2, F.concat(F.lit('{"id":"first","kind":"first",'), F.substring(body, F.lit(2), F.length(body))))
        .when(kind == 3, F.concat(F.lit('{"big":123456789012345678901234567890,'), F.substring(body, F.lit(2), F.length(body))))
        .when(kind == 4, F.concat(F.lit("[0,["), body, F.lit("]]")))
    )
    return _nested(t).select("event_id", F.coalesce(odd, body).alias("body"))


@query("E2 X5", """
with e as (select * from events where event_id % 5 <> 1)
select event_id, 'id' as key, cast(event_id + 1 as varchar) as value, cast(event_id + 1 as double) as number from e
union all select event_id, 'kind', event_type, null from e
union all select event_id, 'amount', cast(value as varchar), value from e
union all select event_id, 'owner', cast(user_id as varchar), cast(user_id as double) from e
union all select event_id, 'big', '123456789012345678901234567890', 123456789012345678901234567890::double from e where event_id % 5 = 3
""")
def json_digest_nested(t: Tables) -> DataFrame:
    return json_digest(_mixed(t), "body", ["event_id"])


@query("E2", """
select event_id, 'no JSON document' as error from events where event_id % 5 = 1
""")
def json_digest_errors(t: Tables) -> DataFrame:
    return digest_errors(_mixed(t), "body", ["event_id"])


@query("E3", """
select event_id, 'k' as key, try_cast(props->>'$.k' as double) as value from events
union all select event_id, 'text', value from events
""")
def numeric_digest_long(t: Tables) -> DataFrame:
    body = F.concat(
        F.expr("substring(props, 1, length(props) - 1)"), F.lit(', "text": "'), F.col("value").cast("string"),
        F.lit('", "word": "'), F.col("event_type"), F.lit('", "on": true}'),
    )
    return numeric_digest(t.events.select("event_id", body.alias("body")), "body", ["event_id"])


@query("E4", """
select event_id, cast(event_id as varchar) as id, event_type as kind, cast(value as varchar) as amount,
  cast(user_id as varchar) as owner, '2' as bare, cast(null as varchar) as too_deep, cast(null as varchar) as missing
from events
""")
def json_path_extract(t: Tables) -> DataFrame:
    """Every third document holds keys twice: the last of them counts."""
    early = F.lit('{"id":"early","meta":{"kind":"early","parts":[]},')
    twice = F.when(F.col("event_id") % 3 == 0, F.concat(early, F.substring("body", 2, 1 << 30))).otherwise(F.col("body"))
    paths = {
        "id": "/id", "kind": ".meta.kind", "amount": "/meta/parts/0/amount", "owner": "|meta|parts|1|owner", "bare": "/bare/1",
        "too_deep": "/id/0", "missing": "/bare/7",
    }
    return X.with_paths(_nested(t).withColumn("body", twice), "body", paths).drop("body")


@query("E11 S15 A8", """
select o_orderkey, cast(o_orderkey % 97 as varchar) as resident, cast(null as varchar) as through_list,
  case when o_orderkey % 97 = 0 then null else round((o_orderkey % 13) / (o_orderkey % 97), 9) end as lock_ratio
from orders
""")
def server_status_paths(t: Tables) -> DataFrame:
    status = F.struct(
        F.struct((F.col("o_orderkey") % 97).alias("resident"), F.array(F.lit(1)).alias("list")).alias("mem"),
        F.struct((F.col("o_orderkey") % 97).cast("double").alias("totalTime"), (F.col("o_orderkey") % 13).cast("double").alias("lockTime")).alias("globalLock"),
    )
    docs = t.orders.select("o_orderkey", F.to_json(status).alias("body"))
    paths = {"total": "globalLock.totalTime", "locked": "globalLock.lockTime", "resident": "mem.resident", "through_list": "mem.list.0"}
    read = X.with_paths(docs, "body", paths, "map")
    held = C.ratio(F.col("locked").try_cast("double"), F.col("total").try_cast("double"))
    return read.select("o_orderkey", "resident", "through_list", F.round(held, 9).alias("lock_ratio"))


@query("E12 X2", """
select p_partkey, 'samplers.jdbc.' || p_type || '.active' as metric, cast(p_size as varchar) as value from part
union all select p_partkey, 'counters.jobs.start', cast(p_partkey & 65535 as varchar) from part
""")
def grouped_values(t: Tables) -> DataFrame:
    def entry(name, value):
        return F.struct(name.alias("name"), value.alias("value"))

    def group(name: str, *entries):
        return F.array(F.struct(F.lit(name).alias("group"), F.array(*entries).alias("data")))

    document = F.struct(
        group("jdbc", entry(F.lit("other"), F.lit(1)), entry(F.concat("p_type", F.lit(".active")), F.col("p_size"))).alias("samplers"),
        group("jobs", entry(F.lit("start"), F.col("p_partkey"))).alias("counters"),
    )
    docs = t.part.select("p_partkey", "p_type", F.to_json(document).alias("body"))
    # The names are those of the six part types; another type would simply not be asked for.
    types = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

    def low_bits(metric: str, value):
        return X.window_id(value).cast("string") if metric.startswith("counters.") else value

    metrics = [*(f"samplers.jdbc.{k}.active" for k in types), "counters.jobs.start"]
    return X.extract_metrics(docs, metrics, X.wrapped("grouped", low_bits), ["p_partkey"])


@query("E5 S10 X1", """
select p_partkey, p_name as name, cast(p_size as varchar) as size, p_brand as brand, cast(null as varchar) as missing from part
""")
def xpath_from_parts(t: Tables) -> DataFrame:
    xml = F.concat(
        F.lit("<part><name>"), F.col("p_name"), F.lit('</name><size unit="cm">'), F.col("p_size").cast("string"),
        F.lit("</size><b>"), F.col("p_brand"), F.lit("</b></part>"),
    )
    body = F.col("body")
    return t.part.select("p_partkey", X.well_formed(xml).alias("body")).select(
        "p_partkey",
        X.xpath_value(body, "//name/text()").alias("name"),
        X.xpath_value(body, "/part/size[@unit='cm']").alias("size"),
        X.xpath_value(body, "//b").alias("brand"),
        X.xpath_value(body, "//none").alias("missing"),
    )


@query("E6", f"""
with {I.RESPONSES_SQL}
select page_id, 'srv/' || id_text as version, cast(page_id * 3 as varchar) as x_head, cast(null as varchar) as missing from responses
""")
def header_extract(t: Tables) -> DataFrame:
    h = F.col("headers")
    return I.responses(t).select(
        "page_id", X.extract_header(h, "server").alias("version"), X.extract_header(h, "x-head").alias("x_head"),
        X.extract_header(h, "none").alias("missing"),
    )


@query("E8", "select o_orderkey, round(o_totalprice, 2) as price, cast(null as double) as bad from orders")
def numeric_coercion(t: Tables) -> DataFrame:
    shown = F.concat(F.lit(" "), F.format_number("o_totalprice", 2), F.lit("\t"))
    return t.orders.select(
        "o_orderkey", C.to_numeric(shown).alias("price"), C.to_numeric(F.concat(F.lit("x"), shown)).alias("bad")
    )


@query("E9", """
with d(metric, data_type) as (values ('click', 'measurement'), ('view', 'trait'), ('error', 'complex'), ('signup', 'measurement'))
select event_id, metric, data_type,
  case when data_type = 'measurement' then value end as dvalue,
  case when data_type = 'trait' then 'v' || user_id end as svalue,
  case when data_type = 'complex' then 'unsupported type complex' end as error
from events join d on metric = event_type
where data_type <> 'measurement' or user_id % 7 <> 0
""")
def typed_dispatch(t: Tables) -> DataFrame:
    definitions = local_table(
        t.spark,
        [("click", "measurement"), ("view", "trait"), ("error", "complex"), ("signup", "measurement")],
        "metric STRING, data_type STRING",
    )
    number = F.when(F.col("user_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    raw = F.when(F.col("event_type") == "view", F.concat(F.lit("  v"), F.col("user_id").cast("string"), F.lit(" "))).otherwise(number)
    values = t.events.select("event_id", F.col("event_type").alias("metric"), raw.alias("value"))
    return R.coerce(values, definitions).select("event_id", "metric", "data_type", "dvalue", "svalue", "error")


@query("E10", """
select doc_id, substr(text, 1, 1024) as output, substr(text, 1, 1000) as description,
  case when length(text) > 100 then substr(text, 1, 100) || '...' else text end as logged
from documents
""")
def text_truncate(t: Tables) -> DataFrame:
    text = F.col("text")
    return t.documents.select(
        "doc_id", X.output_text(text).alias("output"), X.description_text(text).alias("description"), X.log_text(text).alias("logged")
    )


@query("E13 X2", "select event_id, cast((event_id * 7919) & 65535 as varchar) as currentWindowId, cast(event_id * 7919 as varchar) as total from events")
def window_ids(t: Tables) -> DataFrame:
    doc = F.to_json(F.struct((F.col("event_id") * 7919).alias("currentWindowId"), (F.col("event_id") * 7919).alias("total")))
    read = X.wrapped("map", X.low_bits_of_window_ids)
    docs = t.events.select("event_id", doc.alias("body"))
    return docs.select("event_id", *[read(F.col("body"), m).alias(m) for m in ("currentWindowId", "total")])


@query("E14", """
select l_orderkey, l_partkey, l_linenumber, l_suppkey,
  cast(cast(l_orderkey as hugeint) + cast(l_partkey as hugeint) * 4294967296 as varchar) as composed,
  case when l_linenumber <> 3 then cast(cast(l_suppkey as hugeint) + 4294967295::hugeint * 4294967296 as varchar) end as high_end
from lineitem
""")
def compose64(t: Tables) -> DataFrame:
    high = F.when(F.col("l_linenumber") == 3, F.lit(4294967296)).otherwise(F.lit(4294967295))
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
        C.compose64(F.col("l_orderkey"), F.col("l_partkey")).cast("string").alias("composed"),
        C.compose64(F.col("l_suppkey"), high).cast("string").alias("high_end"),
    )


@query("E15 J9", """
select doc_id, case quality when 0 then 'low' when 1 then 'high' else cast(quality as varchar) end as quality_label,
  case toxic when 1 then 'toxic' else cast(toxic as varchar) end as toxic_label
from labels
""")
def enum_decode(t: Tables) -> DataFrame:
    dictionary = local_table(
        t.spark, [("quality", 0, "low"), ("quality", 1, "high"), ("toxic", 1, "toxic")], "name STRING, code INT, label STRING"
    )
    rows = t.labels.withColumns({"q": F.lit("quality"), "x": F.lit("toxic")})
    first = decode_codes(rows, dictionary, "q", "quality", "quality_label")
    return decode_codes(first, dictionary, "x", "toxic", "toxic_label").select("doc_id", "quality_label", "toxic_label")


@query("E16", """
select event_id, event_type,
  case event_type when 'click' then null when 'view' then value when 'error' then event_id * 10.0 when 'purchase' then cast(event_id as double) end as dvalue,
  case event_type when 'click' then case user_id % 3 when 0 then 'idle' when 1 then 'busy' else '2' end when 'signup' then 'u' || user_id end as svalue
from events
""")
def snmp_values(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    var_type = (
        F.when(kind == "click", "Integer32").when(kind == "view", "OctetString").when(kind == "error", "TimeTicks")
        .when(kind == "purchase", "Counter32").otherwise("OctetString")
    )
    raw = (
        F.when(kind == "click", (F.col("user_id") % 3).cast("string")).when(kind == "view", F.col("value").cast("string"))
        .when(kind == "signup", F.concat(F.lit("u"), F.col("user_id").cast("string"))).otherwise(F.col("event_id").cast("string"))
    )
    codes = F.when(kind == "click", F.create_map(F.lit(0), F.lit("idle"), F.lit(1), F.lit("busy")))
    wanted = F.when(kind == "signup", "trait").otherwise("measurement")
    value = C.snmp_value(var_type, raw, wanted, codes)
    return t.events.select("event_id", "event_type", value.alias("_v")).select("event_id", "event_type", "_v.dvalue", "_v.svalue")


@query("E17 X3", """
select p_partkey, 'CapacityTotal' as metric, p_size * 1073741824.0 as value from part
union all select p_partkey, 'FilesTotal', cast(p_partkey as double) from part
""")
def renamed_metrics(t: Tables) -> DataFrame:
    pairs = F.array(
        F.struct(F.lit("CapacityTotalGB").alias("metric"), F.col("p_size").cast("double").alias("value")),
        F.struct(F.lit("FilesTotal").alias("metric"), F.col("p_partkey").cast("double").alias("value")),
        F.struct(F.lit("NotListed").alias("metric"), F.lit(1.0).alias("value")),
    )
    raw = t.part.select("p_partkey", F.inline(pairs))
    m = F.col("metric")
    return raw.select(
        "p_partkey", C.renamed_metric(m, C.STORAGE_RENAMES).alias("metric"),
        C.rescaled_value(m, F.col("value"), C.STORAGE_RENAMES).alias("value"),
    ).filter(F.col("metric").isNotNull())


@query("X3 J1", """
select s_suppkey, 'status' as metric, '{"live":' || (s_suppkey % 9) || ',"dead":"none"}' as value from supplier
union all select s_suppkey, 'live', cast(s_suppkey % 9 as varchar) from supplier
union all select s_suppkey, 'dead', 'none' from supplier
""")
def digest_hook(t: Tables) -> DataFrame:
    status = F.to_json(F.struct((F.col("s_suppkey") % 9).alias("live"), F.lit("none").alias("dead")))
    values = t.supplier.select("s_suppkey", F.lit("status").alias("metric"), status.alias("value"))
    return R.with_digest_hook(values, R.json_valued_attributes(["status"], ["s_suppkey"]))


@query("E18", """
select event_id, case when event_id % 3 = 0 then 0 when event_id % 3 = 1 then 1 else -1 end as liveNodeCount, props as plain from events
""")
def json_map_size(t: Tables) -> DataFrame:
    attr = F.when(F.col("event_id") % 3 == 0, "{}").when(F.col("event_id") % 3 == 1, F.col("props")).otherwise("{oops")
    return t.events.select(
        "event_id", X.count_or_value("liveNodeCount", attr).cast("int").alias("liveNodeCount"),
        X.count_or_value("plain", F.col("props")).alias("plain"),
    )


@query("E23 S5", r"""
select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    replace(regexp_replace(url, '[?#].*$', ''), ' ', '+') || '/dt=2011-07-14/part=r/2011-11-04/201111040900',
    '/[^/=]+=[^/=]+', '', 'g'), '/\d{4}-\d{2}-\d{2}', '', 'g'), '/\d{4,}\b', '', 'g'),
    '^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/?#]*)?', ''), '[?#].*$', '') as path
from pages
""")
def path_normalise(t: Tables) -> DataFrame:
    long = F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit("/dt=2011-07-14/part=r/2011-11-04/201111040900"))
    return t.pages.select("page_id", U.table_path(long).alias("path"))


@query("E24 D13", "select page_id, regexp_replace(url, '\\?.*', '') as url from pages")
def url_scrub(t: Tables) -> DataFrame:
    return t.pages.select("page_id", U.scrub_query(F.col("url")).alias("url"))


@query("E25", r"""
with p as (select page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) as origin,
  regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[?#].*$', '') as path from pages)
select page_id, origin || '/ws/v1/' || page_id || '/x' as rooted,
  origin || regexp_extract(path, '^(.*/)', 1) || 'next' as sibling,
  'http://node' || page_id || ':' || (8000 + page_id) || '/a' as tokened,
  url as unchanged,
  regexp_extract(url, '^([a-z]+://)', 1) || 'gw:' || page_id || regexp_replace(url, '^[a-z]+://[^/?#]*', '') as moved
from p
""")
def url_resolve(t: Tables) -> DataFrame:
    url, n = F.col("url"), F.col("page_id")
    node = F.concat(F.lit("node"), n.cast("string"))
    return t.pages.select(
        "page_id",
        U.resolve_url(U.fill_tokens(F.lit("/ws/v1/@ID@/x"), {U.ID_TOKEN: n}), url).alias("rooted"),
        U.resolve_url(F.lit("next"), url).alias("sibling"),
        U.resolve_url(U.fill_tokens(F.lit("http://HOST:@PORT@/a"), {U.PORT_TOKEN: n + 8000}), url, "HOST", node).alias("tokened"),
        U.resolve_url(url, url).alias("unchanged"),
        U.override_host(url, F.lit("gw"), n).alias("moved"),
    )


@query("E26 D3", r"""
select s_suppkey, 'com.acme.' || s_name as canonical, '01_' || lpad(cast(s_suppkey as varchar), 6, '0') as key,
  'container_77_0001_01_' || lpad(cast(s_suppkey as varchar), 6, '0') as full_id
from supplier
""")
def canonical_names(t: Tables) -> DataFrame:
    app = F.lit("application_77_0001")
    raw = F.concat(F.lit("container_77_0001_01_"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0"))
    key = U.container_key(raw)
    return t.supplier.select(
        "s_suppkey", U.canonical_name(F.concat(F.lit("com/acme/"), "s_name", F.lit(".class"))).alias("canonical"),
        key.alias("key"), U.container_id(app, key).alias("full_id"),
    )


@query("E27", "select event_id, strftime(ts, '%Y-%m-%dT%H:%M+0000') as iso, cast(epoch_ms(date_trunc('second', ts)) as bigint) as ms, cast(null as varchar) as missing from events")
def date_iso(t: Tables) -> DataFrame:
    text = F.date_format("ts", "EEE, d MMM yyyy HH:mm:ss 'GMT'")
    parsed = C.parse_http_date(text)
    return t.events.select(
        "event_id", C.iso_minute(parsed).alias("iso"), C.epoch_ms(parsed).alias("ms"),
        C.iso_minute(C.parse_http_date(F.lit(None).cast("string"))).alias("missing"),
    )


@query("E28", """
select o_orderkey,
  cast(case when o_orderstatus = 'O' then epoch_ms(timestamp '2002-01-01') - epoch_ms(o_orderdate) else (o_orderkey % 30) * 86400000 end as bigint) as elapsed_ms,
  cast(epoch_ms(timestamp '2002-01-01') - epoch_ms(o_orderdate) as bigint) as start_elapsed_ms,
  cast(case when o_orderstatus <> 'O' then epoch_ms(o_orderdate) + (o_orderkey % 30) * 86400000 - epoch_ms(timestamp '2002-01-01') end as bigint) as action_elapsed_ms,
  cast(case when o_orderstatus <> 'O' then epoch_ms(timestamp '2002-01-01') - epoch_ms(o_orderdate) - (o_orderkey % 30) * 86400000 end as bigint) as last_action_recency_ms
from orders
""")
def elapsed_recency(t: Tables) -> DataFrame:
    as_of = F.lit("2002-01-01").cast("timestamp")
    runs = I.job_runs(t).withColumn("elapsed_ms", C.elapsed_ms(F.col("created_time"), F.col("end_time"), as_of))
    return coordinator_times(runs, as_of, "created_time", "end_time").select(
        F.col("run_id").alias("o_orderkey"), "elapsed_ms", "start_elapsed_ms", "action_elapsed_ms", "last_action_recency_ms"
    )


@query("E29", "select doc_id, text, source as from_hex, lang as plain from documents")
def octet_decode(t: Tables) -> DataFrame:
    octets = F.encode("text", "UTF-16BE")
    literal = F.concat(F.lit("0x"), F.hex(F.encode("source", "UTF-8")))
    return t.documents.select(
        "doc_id", C.octets_text(octets, "UTF-16BE").alias("text"),
        C.octets_text(C.hex_bytes(literal)).alias("from_hex"), C.octets_text(C.hex_bytes(F.col("lang"))).alias("plain"),
    )


@query("E33", r"""
select page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 1)) as key,
  unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 2)) as text
from pages
""")
def html_pairs(t: Tables) -> DataFrame:
    pairs = H.cell_pairs(F.col("html"), r'<li><a href="([^"]*)">([^<]*)</a>')
    return t.pages.select("page_id", F.inline(pairs))


@query("E33 A8 S11", """
select s_suppkey, 'quota' as key, round(s_acctbal, 2) as value from supplier where s_acctbal >= 0
union all select s_suppkey, 'servers', cast(s_suppkey % 7 as double) from supplier
union all select s_suppkey, 'requests', cast(s_suppkey as double) from supplier
union all select s_suppkey, 'regions', cast(s_suppkey * 3 as double) from supplier
union all select s_suppkey, 'rserver', s_suppkey * 3.0 / (s_suppkey % 7) from supplier where s_suppkey % 7 <> 0
""")
def html_server_totals(t: Tables) -> DataFrame:
    n = F.col("s_suppkey")
    page = F.concat(
        F.lit("<table><tr><td>quota</td><td>"), F.format_string("%.2f", F.col("s_acctbal")), F.lit("</td></tr><tr><td>name</td><td>x</td></tr></table>Total: servers: "),
        (n % 7).cast("string"), F.lit("&nbsp; requests="), n.cast("string"), F.lit(", regions="), (n * 3).cast("string"), F.lit("<br>"),
    )
    return H.page_pairs(t.supplier.select("s_suppkey", page.alias("html")), "html", ["s_suppkey"])


@query("E32 S11", """
select s_suppkey, 'Maps' as key, cast(s_suppkey as double) as value from supplier
union all select s_suppkey, 'Nodes', s_suppkey * 0.5 from supplier
""")
def html_header_values(t: Tables) -> DataFrame:
    n = F.col("s_suppkey")
    page = F.concat(
        F.lit('<html><table border="1">\n<tr><th>Maps</th><th>Idle</th><th>Nodes</th></tr>\n<tr><td>'), n.cast("string"),
        F.lit('</td><td>-</td><td><a href="x">'), (n * 0.5).cast("string"), F.lit("</a></td></tr>\n</table></html>"),
    )
    pages = t.supplier.select("s_suppkey", page.alias("html"))
    return pages.select("s_suppkey", F.inline(H.header_values(F.col("html"))))


@query("E34 A6", """
select l_orderkey, cast(sum(l_partkey) as bigint) as map_total, cast(sum(l_suppkey) as bigint) as maps_completed,
  cast(sum(l_linenumber) as bigint) as reduce_total, cast(count(*) as bigint) as reduces_completed, cast(count(*) as bigint) as rows
from lineitem group by l_orderkey
""")
def html_queue_stats(t: Tables) -> DataFrame:
    def cell(value) -> object:
        return F.concat(F.lit("<td>"), value.cast("string"), F.lit("</td>"))

    row = F.concat(
        F.lit("<table><tr><th>Job</th></tr><tr><td id='job_1'><a>job</a></td><td>NORMAL</td>"), cell(F.col("l_partkey")), cell(F.col("l_suppkey")),
        F.lit("<td>12.50%</td>"), cell(F.col("l_linenumber")), cell(F.lit(1)), F.lit("</tr><tr><td>7</td></tr></table>"),
    )
    return H.queue_stats(t.lineitem.select("l_orderkey", row.alias("html")), "html", ["l_orderkey"])


@query("E35 A9", r"""
select distinct unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as link from pages
""")
def link_harvest(t: Tables) -> DataFrame:
    return H.harvest_links(t.pages, "html", r'<a href="([^"]*)"')


@query("E36 A11 F12 A5", """
with l as (select user_id, event_id, value, event_type from events)
select user_id, 'queue.' || event_type || '.size' as metric, arg_max(value, event_id) as value from l where event_type in ('click', 'view') group by 1, 2
union all select user_id, 'queue.' || event_type || '.id', cast(max(event_id) as double) from l where event_type in ('click', 'view') group by 1, 2
""")
def log_metrics(t: Tables) -> DataFrame:
    prefix = F.when(F.col("event_type") == "error", F.lit("eventType=")).otherwise(F.lit("01-01-2024 INFO Metrics - group=queue, name="))
    line = F.concat(prefix, "event_type", F.lit(", size="), F.col("value").cast("decimal(12,2)").cast("string"), F.lit(", id="), F.col("event_id").cast("string"))
    logged = t.events.select("user_id", "event_id", line.alias("line"))
    found = T.log_metrics(logged, "line", ["user_id", "event_id"])
    wanted = local_table(
        t.spark, [(f"queue.{k}.{m}",) for k in ("click", "view") for m in ("size", "id")], "metric STRING"
    )
    kept = found.join(wanted, "metric", "left_semi")
    return R.last_wins(kept, ["user_id", "metric"], ["event_id", "pair_no"], ["value"])


@query("S8", """
select o_orderkey, 0 as pos, 'price' as key, printf('%.2f', o_totalprice) as value from orders
union all select o_orderkey, 1, 'cust', cast(o_custkey as varchar) from orders
""")
def stats_dump(t: Tables) -> DataFrame:
    dump = F.concat(
        F.lit("STAT price "), F.format_string("%.2f", F.col("o_totalprice")), F.lit("\r\nSTAT cust "), F.col("o_custkey").cast("string"),
        F.lit("\r\nEND\r\nSTAT after 1\r\n"),
    )
    return T.parse_stats(t.orders.select("o_orderkey", dump.alias("body")), "body", "stat", ["o_orderkey"])


@query("S8", """
select c_custkey, 0 as pos, 'name' as key, c_name as value from customer
union all select c_custkey, 1, 'segment', c_mktsegment from customer
""")
def info_dump(t: Tables) -> DataFrame:
    dump = F.concat(F.lit("# Server\r\nname:"), "c_name", F.lit("\r\n\r\n# Other\r\nsegment:"), "c_mktsegment", F.lit("\r\n"))
    return T.parse_stats(t.customer.select("c_custkey", dump.alias("body")), "body", "info", ["c_custkey"])


@query("S3 S2", r"""
with d as (select doc_id, unnest(string_split(regexp_replace(text, '\n$', ''), chr(10))) as line,
  generate_subscripts(string_split(regexp_replace(text, '\n$', ''), chr(10)), 1) - 1 as line_no from documents where length(text) > 0)
select doc_id, cast(line_no as integer) as line_no, line from d
""")
def document_lines(t: Tables) -> DataFrame:
    return T.lines(t.documents.select("doc_id", "text"), "text")


def _command_runs(t: Tables) -> DataFrame:
    """Line items as command runs: protocol counters, load and disk sizes."""
    part, supp = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    tcp = F.concat(F.lit("Ip:\n    9 total\nTcp:\n    "), part, F.lit(" segments received\n    7 segments send out\n    "), supp, F.lit(" bad segments received.\n"))
    load = F.concat(F.lit(" 10:00:00 up 3 days, 2 users, load average: "), F.col("l_quantity").cast("string"), F.lit(", 0.1, 0.2"))
    sizes = F.concat(part, F.lit("\t/a\nnote 99\n"), supp, F.lit("\t/b/12\n"))
    kind = F.col("l_linenumber") % 3
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(kind == 0, "-s").when(kind == 1, F.lit(None)).otherwise("-sb /data").alias("args"),
        F.when(kind == 0, tcp).when(kind == 1, load).otherwise(sizes).alias("stdout"),
        F.when(F.col("l_linenumber") != 5, 0).alias("exit_code"),
        (F.col("l_partkey") * 1_000_000).alias("elapsed_ns"),
    )


_RUN_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("S13 E44", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, m.metric,
  case m.metric when 'TCP segments received' then cast(l_partkey as double) when 'TCP segments send out' then 7 when 'TCP bad segments' then cast(l_suppkey as double)
    when 'Number of days' then 3 when 'Number of users' then 2 else l_quantity end as value
from lineitem join (values (0, 'TCP segments received'), (0, 'TCP segments send out'), (0, 'TCP bad segments'),
  (1, 'Number of days'), (1, 'Number of users'), (1, 'Load average last minute')) m(kind, metric) on l_linenumber % 3 = kind
""")
def command_metrics(t: Tables) -> DataFrame:
    return CM.command_metrics(_command_runs(t), T.NETSTAT_METRICS | T.UPTIME_METRICS, _RUN_KEYS)


@query("S13 A4", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_partkey + l_suppkey as bigint) as bytes, cast(l_partkey as double) as elapsed_ms
from lineitem where l_linenumber % 3 = 2 and l_linenumber <> 5
""")
def disk_usage(t: Tables) -> DataFrame:
    return CM.disk_usage(_command_runs(t).filter("args like '-sb%'"), _RUN_KEYS)


@query("E37", r"""
select doc_id, regexp_replace(text, '[0-9A-Za-z._-]+@[0-9A-Za-z.-]+', '', 'g') as text from documents
""")
def text_scrub(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.scrub(F.col("text"), r"[0-9A-Za-z._-]+@[0-9A-Za-z.-]+").alias("text"))


@query("E38", """
select event_id, 'type: ' || event_type || chr(10) || 'k: ' || (props->>'$.k') || chr(10) || 'none: null' || chr(10) as detail from events
""")
def event_text(t: Tables) -> DataFrame:
    def line(pos: int, name: str, value):
        return F.struct(F.lit(pos).alias("pos"), F.lit(name).alias("name"), value.alias("value"))

    pairs = F.array(
        line(2, "none", F.lit(None).cast("string")), line(0, "type", F.col("event_type")), line(1, "k", F.get_json_object("props", "$.k"))
    )
    return t.events.select("event_id", ordered_text(pairs).alias("detail"))


@query("E40 F4", """
select s_suppkey, case s_suppkey % 4 when 0 then 30 when 1 then 30 when 2 then 30 else cast(s_suppkey as integer) end as timeout,
  case when s_suppkey % 4 = 0 then 'none' when s_suppkey % 4 = 1 then 'none' else s_name end as label,
  case s_suppkey % 3 when 0 then true when 1 then false else true end as active
from supplier
""")
def config_getters(t: Tables) -> DataFrame:
    n = F.col("s_suppkey")
    number = F.when(n % 4 == 0, F.lit(None)).when(n % 4 == 1, "").when(n % 4 == 2, "3x").otherwise(n.cast("string"))
    label = F.when(n % 4 == 0, F.lit(None)).when(n % 4 == 1, "").otherwise(F.col("s_name"))
    flag = F.when(n % 3 == 0, F.lit(None)).when(n % 3 == 1, "no").otherwise("TRUE")
    return t.supplier.select(
        "s_suppkey", C.typed_int(number, 30).alias("timeout"), C.typed_string(label, "none").alias("label"),
        C.typed_boolean(flag).alias("active"),
    )


# In SQL a Java word boundary is written out, as letters outside ASCII count as word characters too.
_NB = r"(^|[^\p{L}\p{N}_])"


@query("E41", rf"""
with d as (select doc_id, regexp_replace(regexp_replace(text, '[\n\r\t]', ' ', 'g'), ' +', ' ', 'g') as c from documents),
f as (select doc_id, c,
  case when regexp_matches(c, '(?i){_NB}total') then 'Counter' when regexp_matches(c, '(?i){_NB}(number|count)') then 'Gauge' else 'OctetString' end as tag,
  case when regexp_matches(c, '(?i){_NB}k(ilo)?bytes') or regexp_matches(c, '{_NB}KB') then 'kilobytes'
    when regexp_matches(c, '(?i){_NB}m(ega)?bytes') or regexp_matches(c, '{_NB}MB') then 'megabytes'
    when regexp_matches(c, '(?i){_NB}milliseconds') then 'milliseconds' when regexp_matches(c, '(?i){_NB}minutes') then 'minutes'
    when regexp_matches(c, '(?i){_NB}seconds') then 'seconds' when regexp_matches(c, '(?i){_NB}bytes') then 'bytes'
    when regexp_matches(c, '(?i){_NB}percent') then 'percentage' end as units,
  regexp_matches(c, '(?i){_NB}(port|version|id($|[^\p{{L}}\p{{N}}_])|identi|indicat|status|state)') as named,
  regexp_matches(c, '(?i){_NB}(last|recent|previous|prior)') as last
  from d)
select doc_id, substr(c, 1, 1000) as description, units,
  case when tag <> 'OctetString' then 'measurement' else 'trait' end as data_type,
  case when tag = 'Counter' and not last then 'trendsup' end as measurement_type
from f
""")
def metadata_inference(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", F.col("text").alias("descr"), F.lit("OctetString").alias("syntax"))
    return M.infer_definition(docs).select("doc_id", "description", "units", "data_type", "measurement_type")


@query("E41", """
select p_partkey, case p_size % 6 when 0 then 'bytes' when 1 then 'kilobytes' when 2 then 'megabytes' when 3 then null when 4 then null else 'seconds' end as units,
  case when p_size % 6 = 3 then 'trait' else 'measurement' end as data_type,
  case when p_size % 6 = 4 then 'trendsup' end as measurement_type
from part
""")
def metadata_inference_short(t: Tables) -> DataFrame:
    n = F.col("p_size") % 6
    text = (
        F.when(n == 0, F.lit("number of Bytes sent by ")).when(n == 1, "number of KB sent by ").when(n == 2, "number of MB sent by ")
        .when(n == 3, "The\nstate of ").when(n == 4, "Total  requests of ").otherwise("Last total of SECONDS since ")
    )
    rows = t.part.select("p_partkey", F.concat(text, "p_name").alias("descr"), F.lit("Integer32").alias("syntax"))
    return M.infer_definition(rows).select("p_partkey", "units", "data_type", "measurement_type")


@query("E45", f"""
with {I.RESPONSES_SQL}
select code = 200 as success, code as response_code, resource_key as url, 'GET ' || resource_key as request,
  regexp_extract(body, '<title>([^<]*)', 1) as response
from responses
""")
def explain_extraction(t: Tables) -> DataFrame:
    r = I.responses(t)
    return X.explain_extract(
        r, "regex", "<title>([^<]*)", F.concat(F.lit("GET "), F.col("resource_key")), F.col("code") == 200
    )


@query("E42 F13 S15", """
select c_nationkey, cast(c_custkey as bigint) as c_custkey, 'm1' as own,
  case when c_custkey % 3 = 0 then 'm0' when c_custkey % 3 = 1 then 'm1' end as primary_name,
  case c_custkey % 14 when 0 then 'STARTUP' when 1 then 'PRIMARY' when 2 then 'SECONDARY' when 3 then 'RECOVERING' when 4 then 'FATAL'
    when 5 then 'STARTUP2' when 7 then 'ARBITER' when 8 then 'DOWN' when 9 then 'ROLLBACK' when 10 then 'SHUNNED' else 'UNKNOWN' end as state,
  c_custkey % 14 = 1 as master
from customer
""")
def replica_states(t: Tables) -> DataFrame:
    n = F.col("c_custkey")
    members = F.array(
        F.struct(F.lit("m0").alias("name"), F.when(n % 3 == 0, 1).otherwise(2).alias("state"), F.lit(False).alias("self")),
        F.struct(F.lit("m1").alias("name"), F.when(n % 3 == 1, 1).otherwise(2).alias("state"), F.lit(True).alias("self")),
    )
    doc = F.to_json(F.struct(F.when(n % 14 != 13, n % 14).alias("myState"), members.alias("members")))
    body = F.col("body")
    return t.customer.select("c_nationkey", "c_custkey", doc.alias("body")).select(
        "c_nationkey", "c_custkey", RP.self_member(body)["name"].alias("own"), RP.primary_member(body)["name"].alias("primary_name"),
        RP.replica_state(body).alias("state"), RP.is_master(body).alias("master"),
    )
