"""Intervals by dyadic nodes: points find the spans around them by equi-joins.

Node (l, i) stands for the places i * 2**l up to (i + 1) * 2**l. A half-open span of places
is the union of at most two nodes of each level, and a point lies in exactly one node of
each level, so "which spans hold this point" is an equality of nodes: no range join, and
a key with n spans costs n * log(places) rows instead of their square.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import place
from tidemark.session import cut


def span_nodes(low: str, high: str, levels: int) -> Column:
    """The nodes (level, at) whose union is the places ``low`` up to, without, ``high``.

    Columns of type long, 0 <= low, high <= 2**levels; none for an empty or NULL span.
    """
    first = f"shiftright(`{low}` + shiftleft(1L, l) - 1, l)"
    last = f"shiftright(`{high}`, l)"
    left = f"IF({first} < {last} AND {first} % 2 = 1, named_struct('level', l, 'at', {first}), NULL)"
    right = f"IF({first} < {last} AND {last} % 2 = 1, named_struct('level', l, 'at', {last} - 1), NULL)"
    # Above the top level no node can be cut off any more: the rest is one node, or none.
    top = f"IF(`{low}` = 0 AND `{high}` = shiftleft(1L, {levels}), array(named_struct('level', {levels}, 'at', 0L)), array())"
    inner = f"flatten(transform(sequence(0, {levels} - 1), l -> array({left}, {right})))" if levels else "array()"
    return F.expr(f"array_compact(concat({inner}, {top}))") if levels else F.expr(f"array_compact({top})")


def point_nodes(at: str, levels: int) -> Column:
    """The node of each level that holds the place ``at``."""
    return F.expr(f"transform(sequence(0, {levels}), l -> named_struct('level', l, 'at', shiftright(`{at}`, l)))")


def timeline(
    dim: DataFrame, key: str, start: str, end: str, values: Sequence[str], kind: str = "timestamp"
) -> DataFrame:
    """(key, _at, values): from ``_at`` on, the newest version that is valid; NULL for none.

    Versions are half-open, a NULL end is open; of several valid ones the last started
    wins, and of those that start together the one with the larger hash of its values.

    The starts and ends of a key are its places, numbered in order. Each node keeps its
    newest version only, before anything is joined, so a turn meets one version a level
    however many versions of its key are open.
    """
    spans = dim.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(start).cast(kind).alias("_from"),
        F.col(end).cast(kind).alias("_to"), F.struct(*values).alias("_version"),
    )
    spans = cut(spans.withColumn("_hash", F.xxhash64("_version")).withColumn("_id", F.monotonically_increasing_id()))
    turns = spans.select("_key", F.explode(F.array("_from", "_to")).alias("_at")).filter("_at IS NOT NULL").distinct()
    numbered = place(turns, ["_key"], ["_at"]).running_sum(_n=F.lit(1).cast("long")).df
    numbered = cut(numbered.select("_key", "_at", (F.col("_n") - 1).alias("_place")))
    levels = int((numbered.agg(F.max("_place")).first()[0] or 0) + 1).bit_length()
    at = lambda c, name: numbered.select("_key", F.col("_at").alias(c), F.col("_place").alias(name))
    low = spans.join(at("_from", "_low"), ["_key", "_from"]).join(at("_to", "_high"), ["_key", "_to"], "left")
    # An open span ends where the places do.
    high = F.when(F.col("_to").isNull(), F.lit(1 << levels)).otherwise(F.col("_high"))
    order = F.struct("_low", "_hash", "_id").alias("_order")
    nodes = low.withColumn("_high", high).select("_key", order, F.explode(span_nodes("_low", "_high", levels)).alias("_node"))
    newest = nodes.groupBy("_key", "_node").agg(F.max("_order").alias("_order"))
    asked = numbered.select("_key", "_at", F.explode(point_nodes("_place", levels)).alias("_node"))
    found = asked.join(newest, ["_key", "_node"]).groupBy("_key", "_at").agg(F.max("_order")["_id"].alias("_id"))
    named = numbered.select("_key", "_at").join(found, ["_key", "_at"], "left").join(spans.select("_id", "_version"), "_id", "left")
    return named.select(F.col("_key").alias(key), "_at", *[F.col("_version")[v].alias(v) for v in values])


def open_at(
    points: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, start: str, end: str, measure: str | None = None
) -> DataFrame:
    """``points`` with n_open, the spans of the key that hold the point, and with ``measure``
    (a long or decimal column of the spans) also its sum over them, as open_sum.

    ``at``, ``start`` and ``end`` are dates or whole numbers; spans are half-open, a NULL end is
    open, a NULL start or an end not after the start holds nothing. Each point row stays
    once; one with a NULL place or key has 0 and NULL.

    Spans are summed by node before they meet the points, so neither a key with very many
    spans nor a point inside very many of them makes more than one row a level.
    """
    number = lambda df, c: F.unix_date(c) if dict(df.dtypes)[c] == "date" else F.col(c).cast("long")
    rows = cut(points.withColumn("_point", number(points, at).cast("long")).withColumn("_row", F.monotonically_increasing_id()))
    base, last = rows.agg(F.min("_point"), F.max("_point")).first()
    if base is None:
        empty = rows.drop("_point", "_row").withColumn("n_open", F.lit(0).cast("long"))
        return empty.withColumn("open_sum", F.lit(None).cast(dict(spans.dtypes)[measure])) if measure else empty
    levels = int(last - base + 1).bit_length()
    size = 1 << levels
    # Only the part of a span among the points matters.
    low = F.least(F.greatest(number(spans, start) - base, F.lit(0)), F.lit(size)).cast("long")
    high = F.least(F.greatest(F.coalesce(number(spans, end) - base, F.lit(size)), F.lit(0)), F.lit(size)).cast("long")
    placed = spans.filter(F.col(start).isNotNull()).select(
        *keys, F.lit(1).cast("long").alias("_one"), *([F.col(measure).alias("_m")] if measure else []), low.alias("_low"), high.alias("_high")
    )
    nodes = placed.select(*keys, "_one", *(["_m"] if measure else []), F.explode(span_nodes("_low", "_high", levels)).alias("_node"))
    sums = [F.sum("_one").alias("_n")] + ([F.sum("_m").alias("_s")] if measure else [])
    held = nodes.groupBy(*keys, "_node").agg(*sums)
    # Points of one place are asked for once.
    places = rows.filter("_point IS NOT NULL").select(*keys, "_point", (F.col("_point") - base).alias("_place")).distinct()
    asked = places.select(*keys, "_point", F.explode(point_nodes("_place", levels)).alias("_node"))
    totals = [F.sum("_n").alias("n_open")] + ([F.sum("_s").alias("open_sum")] if measure else [])
    found = asked.join(held, [*keys, "_node"]).groupBy(*keys, "_point").agg(*totals)
    out = rows.join(found, [*keys, "_point"], "left").withColumn("n_open", F.coalesce("n_open", F.lit(0)))
    return out.select(*points.columns, "n_open", *(["open_sum"] if measure else []))
