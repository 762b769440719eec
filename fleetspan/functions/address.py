"""Ports, addresses, arguments and versions in command lines and configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.functions.extract import extract_regex
from fleetspan.functions.text import body_lines


def whole_line(line: Column, pattern: str) -> Column:
    """Group 1 where the pattern covers the whole line, else null."""
    anchored = rf"^(?:{pattern})$"
    return F.when(line.rlike(anchored), F.regexp_extract(line, anchored, 1))


# Whole-line patterns of listening ports.
PORT_LINE = r".*?(\d+)"
CONF_PORT_LINE = r"^port\s+(\d+)"
SOURCE_PORT_LINE = r".*sources.*port\s*=\s*(\d+)"


def harvest(df: DataFrame, body: str, keep: list[str], pattern: str = PORT_LINE, out: str = "address") -> DataFrame:
    """Rows (keep..., address): group 1 of every line the pattern covers."""
    return (
        df.select(*keep, F.explode(body_lines(F.col(body))).alias("_line"))
        .select(*keep, whole_line(F.col("_line"), pattern).alias(out))
        .filter(F.col(out).isNotNull())
    )


def first_harvested(body: Column, pattern: str, default: str) -> Column:
    """Group 1 of the first line the pattern covers, else the default."""
    found = F.filter(F.transform(body_lines(body), lambda s: whole_line(s, pattern)), lambda s: s.isNotNull())
    return F.coalesce(F.try_element_at(found, F.lit(1)), F.lit(default))


def parse_address(address: Column, default_host: str = "localhost") -> Column:
    """STRUCT(host, port) of ``host:port`` or a bare port; a bad port is null."""
    pattern = r"(.*):(\d+)"
    return F.when(
        address.rlike(pattern),
        F.struct(
            F.regexp_extract(address, pattern, 1).alias("host"),
            F.regexp_extract(address, pattern, 2).try_cast("int").alias("port"),
        ),
    ).otherwise(F.struct(F.lit(default_host).alias("host"), address.try_cast("int").alias("port")))


def _joined(argv: Column) -> Column:
    return F.array_join(argv, " ")


def argument_after(argv: Column, flag: str) -> Column:
    """Argument that follows the first ``flag``."""
    at = F.array_position(argv, flag)
    return F.when(at > 0, F.try_element_at(argv, (at + 1).cast("int")))


def last_argument_after(argv: Column, flag: str) -> Column:
    """Argument that follows the last ``flag``, the command itself left out."""
    tail = F.reverse(F.slice(argv, 2, 1 << 30))
    at = F.array_position(tail, flag)
    return F.when(at > 1, F.try_element_at(tail, F.greatest(at - 1, F.lit(1)).cast("int")))


def property_value(argv: Column, name: str, value: str = r"\S+") -> Column:
    """Value of the last ``-Dname=value`` argument."""
    pattern = rf"-D{name.replace('.', r'\.')}=({value})"
    found = F.filter(argv, lambda a: a.rlike(pattern))
    return F.regexp_extract(F.try_element_at(found, F.lit(-1)), pattern, 1)


# Property names and defaults of the workflow server.
WORKFLOW_BASE_URL = "oozie.base.url"
WORKFLOW_HOST = "oozie.http.hostname"
WORKFLOW_PORT = "oozie.http.port"


def workflow_url(argv: Column) -> Column:
    """Base URL of a workflow server: the stated one, else host and port with their defaults."""
    base = property_value(argv, WORKFLOW_BASE_URL)
    host = F.coalesce(property_value(argv, WORKFLOW_HOST), F.lit("localhost"))
    port = F.coalesce(property_value(argv, WORKFLOW_PORT, r"\d+"), F.lit("11000"))
    return F.coalesce(base, F.concat(F.lit("http://"), host, F.lit(":"), port, F.lit("/oozie")))


def cache_address(argv: Column) -> Column:
    """STRUCT(host, port) of a cache server from ``-p port`` or ``-l host[:port]``; port 11211 by default."""
    pattern = r"-(p|l)\s*([^:\s]+)(?::(\d+))?"
    text = _joined(argv)
    option = F.regexp_extract(text, pattern, 1)
    value = F.regexp_extract(text, pattern, 2)
    port = F.regexp_extract(text, pattern, 3)
    return F.struct(
        F.when(option == "l", value).otherwise(F.lit("0.0.0.0")).alias("host"),
        F.coalesce(
            F.when(option == "p", value.try_cast("int")).otherwise(port.try_cast("int")), F.lit(11211)
        ).alias("port"),
    )


def document_server_address(argv: Column) -> Column:
    """STRUCT(host, port) from ``--bind_ip`` (first of a list) and ``--port``; 27017 by default."""
    bind = last_argument_after(argv, "--bind_ip")
    return F.struct(
        F.coalesce(F.try_element_at(F.split(bind, ","), F.lit(1)), F.lit("localhost")).alias("host"),
        F.coalesce(last_argument_after(argv, "--port").try_cast("int"), F.lit(27017)).alias("port"),
    )


def _conf_position(argv: Column) -> Column:
    """Position of the last argument that names a file: no flag, and not the value of ``--port``."""
    marks = F.transform(
        argv,
        lambda a, i: (i > 0) & ~a.startswith("-") & (F.try_element_at(argv, F.greatest(i, F.lit(1))) != "--port"),
    )
    back = F.array_position(F.reverse(marks), True)
    return F.when(back > 0, (F.size(argv) + 1 - back).cast("int"))


def key_store_conf(argv: Column, cwd: Column) -> Column:
    """Absolute path of the configuration file among the arguments; null without one."""
    conf = F.try_element_at(argv, _conf_position(argv))
    return F.when(conf.startswith("/"), conf).otherwise(F.concat(cwd, F.lit("/"), conf))


# Fixed value: the port of a key-value server that states none.
KEY_STORE_PORT = 6379


def key_store_conf_port(conf_body: Column) -> Column:
    """Port that a key-value server's configuration file states, else the usual one."""
    return first_harvested(conf_body, CONF_PORT_LINE, str(KEY_STORE_PORT)).try_cast("int")


def key_store_port_of(argv: Column, conf_port: Column) -> Column:
    """Port of a key-value server: of ``--port N`` or the configuration file, the later one wins; 6379 by default."""
    flag = last_argument_after(argv, "--port").try_cast("int")
    flag_at = F.size(argv) + 1 - F.array_position(F.reverse(argv), "--port")
    conf_at = _conf_position(argv)
    return F.coalesce(
        F.when(conf_at.isNotNull() & (flag.isNull() | (conf_at > flag_at)), conf_port), flag, F.lit(KEY_STORE_PORT)
    )


def key_store_port(argv: Column, conf_body: Column) -> Column:
    """Port of a key-value server whose configuration file was read."""
    return key_store_port_of(argv, key_store_conf_port(conf_body))


def database_identity(argv: Column) -> Column:
    """STRUCT(name, port, version) of a database server's command line."""
    text = _joined(argv)
    return F.struct(
        F.coalesce(extract_regex(text, r"TimesTen/(\w+)/"), F.lit("tten")).alias("name"),
        F.coalesce(extract_regex(text, r"-p\s+(\d+)").try_cast("int"), F.lit(53397)).alias("port"),
        F.coalesce(extract_regex(text, r"product/([^/]+)/"), F.lit("")).alias("version"),
    )


def java_main(argv: Column) -> Column:
    """The command line from its first ``org.apache.`` argument on."""
    hits = F.transform(argv, lambda a: a.startswith("org.apache."))
    at = F.array_position(hits, True)
    return F.when(at > 0, F.array_join(F.slice(argv, at.cast("int"), F.size(argv)), " ")).otherwise(F.lit(""))


# Where versions are found.
JAR_VERSION = r"([0-9\.+\-\w]+).jar"
SERVER_JARS = ["hbase-" + JAR_VERSION, "hadoop-core-" + JAR_VERSION, "zookeeper-" + JAR_VERSION]
COLLECTOR_JARS = ["flume-ng-core-" + JAR_VERSION]
DEVICE_VERSION = r"(\d+\.[.\d]+)\b"
CONFIG_CLIENT_VERSION = r"vd (\S+) "
BUILD_VERSION = r"(\S+).*rev: (\w+).*"


def version_of(text: Column, patterns: list[str]) -> Column:
    """Group 1 of the first pattern that matches, in the order given."""
    return F.coalesce(*[extract_regex(text, p) for p in patterns])


def version_of_arguments(argv: Column, patterns: list[str]) -> Column:
    """Version of the first argument that any pattern matches."""
    any_pattern = "|".join(f"(?:{p})" for p in patterns)
    return version_of(F.try_element_at(F.filter(argv, lambda a: a.rlike(any_pattern)), F.lit(1)), patterns)


def build_version(text: Column) -> Column:
    """``version revision`` of a build string; other text is returned as it is."""
    anchored = rf"^(?:{BUILD_VERSION})$"
    return F.when(
        text.rlike(anchored),
        F.concat_ws(" ", F.regexp_extract(text, anchored, 1), F.regexp_extract(text, anchored, 2)),
    ).otherwise(text)


def client_version(text: Column) -> Column:
    """Version in a client's banner, else the banner itself."""
    return F.coalesce(extract_regex(text, CONFIG_CLIENT_VERSION), text)
