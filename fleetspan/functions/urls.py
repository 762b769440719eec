"""URL, path and name rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def table_path(path: Column) -> Column:
    """Directory of a table: partition, date and time steps dropped, URI path only."""
    # What marks a step as a partition, a date or a time.
    text = F.replace(path, F.lit(" "), F.lit("+"))
    text = F.regexp_replace(text, r"/[^/=]+=[^/=]+", "")
    text = F.regexp_replace(text, r"/\d{4}-\d{2}-\d{2}", "")
    text = F.regexp_replace(text, r"/\d{4,}\b", "")
    return uri_path(text)


def uri_path(uri: Column) -> Column:
    """Decoded path part of a URI."""
    path = F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/?#]*)?|[?#].*$", "")
    # Form decoding would turn a plus into a space; a URI path keeps it.
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def scrub_query(url: Column) -> Column:
    """URL without its query string, which may hold a password."""
    return F.regexp_replace(url, r"(?s)\?.*", "")


# Tokens replaced in configured URLs.
PORT_TOKEN = "@PORT@"
ID_TOKEN = "@ID@"


def fill_tokens(url: Column, tokens: dict[str, Column]) -> Column:
    """Replace each token by its value; a missing value counts as empty."""
    for token, value in tokens.items():
        url = F.replace(url, F.lit(token), F.coalesce(value.cast("string"), F.lit("")))
    return url


_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"


def resolve_url(url: Column, parent: Column, host_token: str | None = None, host: Column | None = None) -> Column:
    """Absolute URL: the host token becomes the real host, a relative URL is resolved on its parent."""
    if host_token is not None and host is not None:
        at_host = rf"^([A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?){host_token}(?=[:/?#]|$)"
        url = F.when(
            url.rlike(at_host),
            F.concat(F.regexp_extract(url, at_host, 1), host, F.regexp_replace(url, at_host, "")),
        ).otherwise(url)
    origin = F.regexp_extract(parent, _ORIGIN, 1)
    parent_path = F.regexp_replace(F.regexp_replace(parent, _ORIGIN, ""), r"[?#].*$", "")
    directory = F.coalesce(F.nullif(F.regexp_extract(parent_path, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    return (
        F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), url)
        .when(url.startswith("//"), F.concat(F.regexp_extract(parent, r"^([^:/]+:)", 1), url))
        .when(url.startswith("/"), F.concat(origin, url))
        .when(url == "", parent)
        .otherwise(F.concat(origin, directory, url))
    )


def override_host(url: Column, host: Column, port: Column) -> Column:
    """URL on a discovered host and port, where there is one."""
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://)", 1)
    rest = F.regexp_replace(url, _ORIGIN, "")
    return F.when(host.isNull(), url).otherwise(F.concat(scheme, host, F.lit(":"), port.cast("string"), rest))


def canonical_name(name: Column) -> Column:
    """Application name without ``.class``, its slashes as dots."""
    return F.replace(F.replace(name, F.lit(".class"), F.lit("")), F.lit("/"), F.lit("."))


def container_key(container_id: Column) -> Column:
    """Trailing ``number_number`` of a container id; null when there is none."""
    return F.regexp_substr(container_id, F.lit(r"\d+_\d+$"))


def container_id(app_id: Column, key: Column) -> Column:
    """Full container id rebuilt from its application's id and its key."""
    return F.concat(F.lit("container"), F.substring(app_id, len("application") + 1, 1 << 30), F.lit("_"), key)


def origin(url: Column) -> Column:
    return F.regexp_extract(url, _ORIGIN, 1)


def path_steps(path: Column) -> Column:
    """Non-empty steps of a path."""
    return F.filter(F.split(path, "/"), lambda s: s != "")


def path_prefixes(path: Column, depth: int | None = None) -> Column:
    """The path's ancestors and itself, ``/a``, ``/a/b`` and so on, down to ``depth`` steps."""
    steps = path_steps(path)
    levels = F.size(steps) if depth is None else F.least(F.size(steps), F.lit(depth))
    return F.transform(
        F.filter(F.sequence(F.lit(0), levels), lambda n: n > 0),
        lambda n: F.concat(F.lit("/"), F.array_join(F.slice(steps, 1, n), "/")),
    )
