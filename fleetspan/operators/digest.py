"""Digest of JSON documents: every leaf number and string under its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ENTRY = "ARRAY<STRUCT<key: STRING, kind: STRING, text: STRING>>"

#: Strings, marks and bare words; a quote that nothing closes is a token of its own. Possessive, so nothing is tried twice and no stack grows with the text.
_TOKEN = r'"(?:[^"\\]|\\.)*+"|[{}\[\]:,"]|[^\s{}\[\]:,"]++'
_NUMBER = r"^-?(0|[1-9]\d*+)(\.\d++)?([eE][+-]?\d++)?$"
_STRING = r'^"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*+"$'
_WORDS = ("true", "false", "null", "NaN", "Infinity", "-Infinity")

#: A key with a scalar behind it, in groups, or else a string: these are taken whole, so nothing is looked for inside them.
_LEAF = r'("(?:[^"\\]|\\.)*+")\s*+:\s*+("(?:[^"\\]|\\.)*+"|[^\s{}\[\]:,"]++)|"(?:[^"\\]|\\.)*+"'
#: Length below which no limit of Spark's parser is reached.
_SHORT = 1000
#: Levels that one number of the grammar's stack holds, and the width at which full numbers are put aside.
_LEVELS, _WIDTH = 60, 16


def _tokens(body: Column) -> Column:
    """Strings (in quotes), marks and bare words of a document, in order."""
    return F.regexp_extract_all(body, F.lit(f"(?s){_TOKEN}"), F.lit(0))


def _unquoted(token: Column) -> Column:
    """Text of a string token."""
    # Only a token with an escape is parsed.
    parsed = F.from_json(F.concat(F.lit("["), token, F.lit("]")), "ARRAY<STRING>")[0]
    return F.when(F.instr(token, "\\") > 0, parsed).otherwise(F.substring(token, F.lit(2), F.length(token) - 2))


def grammatical(tokens: Column) -> Column:
    """Whether tokens make one JSON object or list, at any size and depth.

    An automaton over the list. Its state says what may follow: ``S`` the root,
    ``A`` a value or the end of an empty list, ``V`` a value, ``O`` a key or the
    end of an empty object, ``K`` a key, ``C`` a colon, ``E`` a comma or an end.
    The stack has one bit per level, 1 for an object: the innermost levels in a
    number, full numbers in a text.
    """
    def struct(state: Column, top: Column, n: Column, rest: Column) -> Column:
        return F.struct(state.alias("s"), top.cast("bigint").alias("top"), n.cast("int").alias("n"), rest.alias("rest"))

    def step(a: Column, t: Column) -> Column:
        state, top, n, rest = a["s"], a["top"], a["n"], a["rest"]
        kept = lambda s: struct(s, top, n, rest)
        value = state.isin("A", "V")
        inside, in_object = n > 0, F.pmod(top, F.lit(2)) == 1

        def opened(bit: int, s: str) -> Column:
            full = n == _LEVELS
            return struct(
                F.lit(s), F.when(full, F.lit(bit)).otherwise(top * 2 + bit), F.when(full, 1).otherwise(n + 1),
                F.when(full, F.concat(rest, F.lpad(F.hex(top), _WIDTH, "0"))).otherwise(rest),
            )

        again = (n == 1) & (rest != "")
        closed = struct(
            F.lit("E"),
            F.when(again, F.conv(F.right(rest, F.lit(_WIDTH)), 16, 10).cast("bigint")).otherwise(F.shiftright(top, 1)),
            F.when(again, F.lit(_LEVELS)).otherwise(n - 1),
            F.when(again, F.left(rest, F.length(rest) - _WIDTH)).otherwise(rest),
        )
        return (
            F.when(state == "X", a)
            .when((t == "{") & (value | (state == "S")), opened(1, "O"))
            .when((t == "[") & (value | (state == "S")), opened(0, "A"))
            .when((t == "}") & state.isin("E", "O") & inside & in_object, closed)
            .when((t == "]") & state.isin("E", "A") & inside & ~in_object, closed)
            .when((t == ",") & (state == "E") & inside, kept(F.when(in_object, "K").otherwise("V")))
            .when((t == ":") & (state == "C"), kept(F.lit("V")))
            .when(state.isin("O", "K") & t.rlike(_STRING), kept(F.lit("C")))
            .when(value & (t.rlike(_STRING) | t.isin(*_WORDS) | t.rlike(_NUMBER)), kept(F.lit("E")))
            .otherwise(kept(F.lit("X")))
        )

    start = struct(F.lit("S"), F.lit(0), F.lit(0), F.lit(""))
    return F.aggregate(tokens, start, step, lambda a: (a["s"] == "E") & (a["n"] == 0))


def well_formed(body: Column) -> Column:
    """Whether a body is one JSON object or list, and nothing else.

    Spark's parser stops behind the first value, so it is asked for the body as
    the one item of a list and as the one value of an object: what might follow
    the value fits one of them at most. It refuses a thousand levels, and very long
    names and numbers; so what it refuses goes through the grammar, unless it is
    too short for any of these.
    """
    def parsed(before: str, after: str) -> Column:
        return F.from_json(F.concat(F.lit(before), body, F.lit(after)), "VARIANT", {"allowSingleQuotes": "false"}).isNotNull()

    whole = parsed("[", "]") & parsed('{"a":', "}")
    return F.coalesce(body.rlike(r"^\s*[\{\[]") & (whole | ((F.length(body) >= _SHORT) & grammatical(_tokens(body)))), F.lit(False))


def digest_entries(body: Column) -> Column:
    """ARRAY<STRUCT(key, kind, text)> of a document, by key; kind is ``n`` for a number, ``s`` for a string.

    Booleans, nulls, empty strings and bare list elements are left out; of a
    repeated key the last leaf in document order counts. A leaf is a string, a
    colon and a scalar, at whatever depth, so flat, nested and very deep
    documents are read alike, by patterns inside the JVM. Null for a broken
    document: see ``digest_errors``.
    """
    def last_of_key(all_: Column) -> Column:
        following = lambda i: F.get(all_, i + 1)["key"]
        return F.filter(all_, lambda e, i: ~e["key"].eqNullSafe(following(i)))

    def leaves(whole: Column) -> Column:
        group = lambda n: F.regexp_extract_all(whole, F.lit(f"(?s){_LEAF}"), F.lit(n))
        pairs = F.filter(F.arrays_zip(group(1).alias("key"), group(2).alias("text")), lambda e: (e["key"] != "") & (e["text"] != '""'))

        def named(e: Column, i: Column) -> Column:
            string = F.startswith(e["text"], F.lit('"'))
            kind = F.when(string, "s").when(e["text"].rlike(_NUMBER), "n")
            return F.struct(_unquoted(e["key"]).alias("key"), i.alias("at"), kind.alias("kind"), F.when(string, _unquoted(e["text"])).otherwise(e["text"]).alias("text"))

        # Sorted by key and place, so that the last leaf of a key is the one before another key.
        found = F.filter(F.transform(pairs, named), lambda e: e["kind"].isNotNull())
        return F.transform(F.array(F.sort_array(found)), last_of_key)[0]

    # One-element lists bind what is computed once.
    bound = F.transform(F.array(F.when(well_formed(body), body)), lambda t: F.when(t.isNotNull(), leaves(t)))[0]
    return F.transform(bound, lambda e: F.struct(e["key"].alias("key"), e["kind"].alias("kind"), e["text"].alias("text"))).cast(_ENTRY)


def digest_errors(df: DataFrame, body: str, keep: list[str]) -> DataFrame:
    """Rows (keep..., error) of the documents that a digest finds broken."""
    broken = F.col(body).isNotNull() & ~well_formed(F.col(body))
    return df.filter(broken).select(*keep, F.lit("no JSON document").alias("error"))


def json_digest(df: DataFrame, body: str, keep: list[str]) -> DataFrame:
    """Rows (keep..., key, value, number) of every leaf of every document.

    ``number`` is null for a string. A fraction or exponent is shown as a double.
    """
    text = F.col("_e.text")
    value = F.when((F.col("_e.kind") == "n") & text.rlike("[.eE]"), text.try_cast("double").cast("string")).otherwise(text)
    return df.select(*keep, F.explode(digest_entries(F.col(body))).alias("_e")).select(
        *keep,
        F.col("_e.key").alias("key"),
        value.alias("value"),
        F.when(F.col("_e.kind") == "n", text.try_cast("double")).alias("number"),
    )


def numeric_digest(df: DataFrame, body: str, keep: list[str]) -> DataFrame:
    """Rows (keep..., key, value DOUBLE) of the numbers and of the strings that parse as one."""
    return (
        df.select(*keep, F.explode(digest_entries(F.col(body))).alias("_e"))
        .select(*keep, F.col("_e.key").alias("key"), F.col("_e.text").try_cast("double").alias("value"))
        .filter(F.col("value").isNotNull())
    )
