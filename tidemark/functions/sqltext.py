"""Logged SQL texts by their tokens: what stands in literals, comments or quoted names is no keyword.

All are Catalyst columns: one pattern finds the tokens, higher-order functions walk them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import CHAINED, COST_TABLES, FORBIDDEN, FORBIDDEN_VERBS, NO_TABLE, NOT_SELECT

UNKNOWN_TABLE = "Unknown table: "
COMMENT = r"--[^\n]*|/\*.*?(?:\*/|\z)"
LITERAL = r"'[^']*(?:'|\z)"
PART = r'(?:"[^"]*"|`[^`]*`|\w+)'
TOKEN = rf"(?s){COMMENT}|{LITERAL}|{PART}(?:\.{PART})*|\S"
# Words that end the list of tables of a FROM.
AFTER_FROM = ["WHERE", "GROUP", "HAVING", "ORDER", "LIMIT", "WINDOW", "UNION", "EXCEPT", "INTERSECT", "QUALIFY"]
# Words that may stand between FROM or JOIN and a table.
BEFORE_TABLE = ["LATERAL", "ONLY"]


def tokens(sql: Column) -> Column:
    """The tokens without comments; bare words in upper case, literals as '' , quoted names with quotes.

    A doubled quote makes two adjacent literals, which changes nothing here. A literal or
    comment without an end goes on to the end of the text.
    """
    found = F.regexp_extract_all(F.coalesce(sql, F.lit("")), F.lit(TOKEN), F.lit(0))
    kept = F.filter(found, lambda t: ~(t.startswith("--") | t.startswith("/*")))
    plain = lambda t: F.when(t.startswith("'"), "''").when(t.rlike('["`]'), t).otherwise(F.upper(t))
    return F.transform(kept, plain)


def verbs(found: Column, wanted: Sequence[str] = FORBIDDEN_VERBS) -> Column:
    """Those of the wanted keywords that occur as bare words, in the order wanted."""
    return F.array_intersect(F.array(*[F.lit(v) for v in wanted]), found)


def statements(found: Column) -> Column:
    """The number of statements; empty ones between semicolons do not count."""
    start = F.struct(F.lit(0).alias("n"), F.lit(";").alias("last"))
    step = lambda a, t: F.struct((a["n"] + ((t != ";") & (a["last"] == ";")).cast("int")).alias("n"), t.alias("last"))
    return F.aggregate(found, start, step, lambda a: a["n"])


def tables(found: Column) -> Column:
    """The tables read, sorted, in lower case without quotes: names after FROM, JOIN and the commas
    of a FROM, in subqueries too, without the names that a WITH defines (``name AS (``).

    FROM inside a call, as in EXTRACT(year FROM ts), and IS DISTINCT FROM name no table. A
    name that a WITH defines is taken out everywhere in the text; one defined with a list
    of columns is not seen as defined and stays.
    """
    is_name = lambda t: t.rlike(r'^["`\w]')
    none = F.lit(None).cast("string")
    start = F.struct(
        F.lit(False).alias("want"),
        F.array(F.lit("")).alias("open"),  # innermost first: '' other, S select, F its list of tables
        none.alias("last"),
        none.alias("before"),
        F.array().cast("array<string>").alias("read"),
        F.array().cast("array<string>").alias("defined"),
    )

    def step(a: Column, t: Column) -> Column:
        top = F.get(a["open"], F.lit(0))
        rest = F.slice(a["open"], 2, F.greatest(F.size(a["open"]) - 1, F.lit(0)))
        put = lambda mark: F.concat(F.array(F.lit(mark)), rest)
        reads = (t == "FROM") & ((top == "S") | (a["last"] == "DELETE")) & ~F.coalesce(a["last"] == "DISTINCT", F.lit(False))
        reads = F.coalesce(reads, F.lit(False))
        named = a["want"] & is_name(t) & ~t.isin("SELECT", "WITH", "VALUES", *BEFORE_TABLE)
        opened = (
            F.when(t == "(", F.concat(F.array(F.when(a["want"], "F").otherwise("")), a["open"]))
            .when(t == ")", F.when(F.size(rest) > 0, rest).otherwise(F.array(F.lit(""))))
            .when(t == "SELECT", put("S"))
            .when(t == ";", F.array(F.lit("")))
            .when(reads, put("F"))
            .when((top == "F") & t.isin(*AFTER_FROM), put("W"))
            .otherwise(a["open"])
        )
        wants = (
            F.when(reads | ((top == "F") & t.isin("JOIN", ",")), F.lit(True))
            .when(t.isin("(", *BEFORE_TABLE), a["want"])
            .otherwise(F.lit(False))
        )
        defines = F.coalesce((t == "(") & (a["last"] == "AS") & is_name(a["before"]), F.lit(False))
        return F.struct(
            wants.alias("want"),
            opened.alias("open"),
            t.alias("last"),
            a["last"].alias("before"),
            F.when(named, F.array_append(a["read"], t)).otherwise(a["read"]).alias("read"),
            F.when(defines, F.array_append(a["defined"], a["before"])).otherwise(a["defined"]).alias("defined"),
        )

    bare = lambda names: F.transform(names, lambda t: F.lower(F.regexp_replace(t, '["`]', "")))
    return F.aggregate(found, start, step, lambda a: F.array_sort(F.array_except(bare(a["read"]), bare(a["defined"]))))


def log_errors(sql: Column, wanted: Sequence[str] = FORBIDDEN_VERBS, allowed: Sequence[str] = COST_TABLES) -> Column:
    """The rules that a SQL text breaks: forbidden keywords, no SELECT (a WITH may lead to it), more than
    one statement, none of the allowed tables, each table that is not allowed. NULL is an empty text.
    """
    found = tokens(sql)
    read = tables(found)
    known = F.array(*[F.lit(t) for t in allowed])
    selects = F.coalesce((F.get(found, F.lit(0)) == "SELECT") | ((F.get(found, F.lit(0)) == "WITH") & F.array_contains(found, "SELECT")), F.lit(False))
    rules = F.array(
        F.when(~selects, F.lit(NOT_SELECT)),
        F.when(statements(found) > 1, F.lit(CHAINED)),
        F.when(~F.arrays_overlap(read, known), F.lit(NO_TABLE + ", ".join(allowed))),
    )
    return F.concat(
        F.transform(verbs(found, wanted), lambda v: F.concat(F.lit(FORBIDDEN), v)),
        F.array_compact(rules),
        F.transform(F.array_except(read, known), lambda t: F.concat(F.lit(UNKNOWN_TABLE), t)),
    )
