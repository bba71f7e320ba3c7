"""URL filters: host-suffix and path-prefix expressions joined with rules by hash.

A rule is a host with all its subdomains and the beginning of a path. Each distinct
(host, path) is expanded into the expressions that a rule could be: host suffixes at label
bounds and path prefixes, of lengths that rules have. They meet the rules by a short hash
prefix; full digests confirm, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import without

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def expression(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def _prefix(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def expand(host: Column, path: Column, hosts: list[int], closed: list[int], open_: list[int]) -> Column:
    """All (host suffix, path prefix) expressions of the given lengths.

    ``closed`` are lengths of rule paths that end in a slash, ``open_`` of other rule paths.
    """
    suffixes = F.filter(
        F.transform(F.array(*[F.lit(n) for n in hosts]), lambda n: F.when(
            (F.length(host) == n) | ((F.length(host) > n) & (F.substr(host, F.length(host) - n, F.lit(1)) == ".")),
            F.substr(host, F.length(host) - n + 1, n),
        )),
        lambda s: s.isNotNull(),
    )
    ends = [F.when((F.length(path) >= n) & (F.substring(path, n, 1) == "/"), F.substring(path, 1, n)) for n in closed]
    ends += [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in open_ if n]
    ends += [F.lit("")] if 0 in open_ else []
    prefixes = F.filter(F.array(*ends), lambda p: p.isNotNull())
    return F.flatten(
        F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct(s.alias("suffix"), p.alias("prefix"))))
    )


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", digits: int = 8
) -> DataFrame:
    """Adds host, path, rule (as written: host and path; null if none fits) and verdict.

    ``rules``: host, path, verdict. Hosts are compared as url_host gives them; a rule fits
    its host and all subdomains if the path starts with the rule's, case and all. The
    longest rule (host and path together, then the longer host) wins; a rule that both
    allows and blocks, blocks. No fitting rule: ``default``. A null url or one without
    ``://`` has an empty host, which only a rule with an empty host fits. Rules with a null
    host, path or verdict do not count. Repeated rows are each judged; columns with these
    names are replaced.

    Only the lengths that rules have reach the driver (at most as many as the longest rule
    has characters). Expansion works on distinct (host, path) pairs, so a host with a third
    of all pages is expanded once for each of its paths; the joins split skewed keys.
    """
    whole = rules.select("host", "path", "verdict").dropna()
    table = whole.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("blocks"), F.min("verdict").alias("first"))
    table = table.select(
        expression(F.col("host"), F.col("path")).alias("digest"),
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"),
        F.when(F.col("blocks"), "block").otherwise(F.col("first")).alias("rule_verdict"),
    )
    ends = F.col("path").endswith("/")
    lengths = whole.agg(
        F.collect_set(F.length("host")).alias("hosts"),
        F.collect_set(F.when(ends, F.length("path"))).alias("closed"),
        F.collect_set(F.when(~ends, F.length("path"))).alias("open"),
    ).first()
    parsed = without(pages, "host", "path", "rule", "verdict").withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    if not lengths.hosts:
        return parsed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    one = parsed.select("host", "path").distinct()
    spread = one.withColumn("e", F.explode(expand(F.col("host"), F.col("path"), sorted(lengths.hosts), sorted(lengths.closed), sorted(lengths.open))))
    hashed = spread.withColumn("digest", expression(F.col("e.suffix"), F.col("e.prefix"))).drop("e")
    found = (
        hashed.withColumn("short", _prefix(F.col("digest"), digits))
        .join(table.withColumn("short", _prefix(F.col("digest"), digits)).withColumnRenamed("digest", "full"), "short")
        .filter(F.col("digest") == F.col("full"))
    )
    won = found.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule"), F.col("host_length"), F.col("rule"), F.col("rule_verdict").alias("verdict"))).alias("won")
    )
    named = won.select(F.col("host").alias("_h"), F.col("path").alias("_p"), F.col("won.rule").alias("rule"), F.col("won.verdict").alias("verdict"))
    out = parsed.join(named, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left").drop("_h", "_p")
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
