"""Copies of a table compared by trees of checksums; only ranges that differ are compared by row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut

MOST_BITS = 20


def _hash(seed: int, columns: Sequence[str]) -> Column:
    """A hash that a NULL changes too: the built-in one passes over NULLs."""
    named = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(F.lit(seed), *named, *[c.isNull() for c in named])


def leaf_of(keys: Sequence[str], bits: int) -> Column:
    """The range of hashed keys that a row is in, from 0 to 2 ** bits - 1."""
    if not 1 <= bits <= MOST_BITS:
        raise ValueError(f"bits must be from 1 to {MOST_BITS}")
    return F.shiftrightunsigned(_hash(0, keys), 64 - bits)


def checksum_tree(df: DataFrame, keys: Sequence[str], bits: int = 16, step: int = 4) -> DataFrame:
    """(depth, node, n, total, mixed): row counts and two checksums of each range of keys.

    Depth 0 is the whole table; a node of depth d has up to 2 ** step children at depth
    d + step, the leaves are at ``bits``. Neither the order nor the partitions of the rows
    matter, repeated rows do. Rows are summed where they are read; a task sends at most
    2 ** bits sums. The tree can be kept, or made where the copy is: a later comparison
    does not need the rows.
    """
    if bits % step:
        raise ValueError("bits must be a multiple of step")
    leaves = (
        df.select(leaf_of(keys, bits).alias("leaf"), _hash(1, df.columns).alias("one"), _hash(2, df.columns).alias("two"))
        .groupBy("leaf")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("one").cast("decimal(20,0)")).alias("total"), F.bit_xor("two").alias("mixed"))
    )
    places = [F.struct(F.lit(d).alias("depth"), F.shiftright("leaf", bits - d).alias("node")) for d in range(0, bits + 1, step)]
    return (
        leaves.withColumn("at", F.explode(F.array(*places)))
        .groupBy(F.col("at.depth").alias("depth"), F.col("at.node").alias("node"))
        .agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"), F.bit_xor("mixed").alias("mixed"))
    )


def differing_nodes(a: DataFrame, b: DataFrame, bits: int = 16, step: int = 4) -> DataFrame:
    """(depth, node, rows_a, rows_b) of the nodes of two trees that differ, from the top down:
    children of equal nodes are not looked at.
    """
    out, above = None, None
    for depth in range(0, bits + 1, step):
        sides = []
        for tree, name in ((a, "a"), (b, "b")):
            mine = tree.filter(F.col("depth") == depth)
            if above is not None:
                mine = mine.withColumn("up", F.shiftright("node", step)).join(above, "up", "left_semi")
            sides.append(mine.select("node", F.col("n").alias(f"rows_{name}"), F.struct("n", "total", "mixed").alias(name)))
        both = sides[0].join(sides[1], "node", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
        found = both.select(F.lit(depth).alias("depth"), "node", *[F.coalesce(f"rows_{c}", F.lit(0)).cast("long").alias(f"rows_{c}") for c in "ab"])
        above = found.select(F.col("node").alias("up"))
        out = found if out is None else out.unionByName(found)
    return out


def suspects(df: DataFrame, keys: Sequence[str], leaves: DataFrame, bits: int = 16) -> DataFrame:
    """The rows in the given leaves (node), without a shuffle: at most 2 ** bits leaves are sent."""
    return df.join(F.broadcast(leaves), leaf_of(keys, bits) == F.col("node"), "left_semi")


def tree_differences(a: DataFrame, b: DataFrame, keys: Sequence[str], bits: int = 16, step: int = 4) -> DataFrame:
    """The rows that only one copy has, as often as it has them more: the columns and ``only_in``.

    The result of ``exceptAll`` both ways, but only rows of leaves that differ move. ``keys``
    may repeat and hold NULLs; they should be many, as a leaf is compared as a whole. Both
    copies have the same columns, in any order; maps cannot be compared. Copies that agree
    cost two scans. Two 64-bit checksums and the count of a leaf would have to collide for
    a difference to be missed.
    """
    b = b.select(*[F.col(f"`{c}`") for c in a.columns])
    trees = [cut(checksum_tree(t, keys, bits, step)) for t in (a, b)]
    leaves = cut(differing_nodes(*trees, bits, step).filter(F.col("depth") == bits).select("node"))
    return signed_rows(suspects(a, keys, leaves, bits), suspects(b, keys, leaves, bits))


def signed_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows of which one side has more, in one shuffle: +1 and -1 summed per row."""
    columns = a.columns
    whole = [F.col(f"`{c}`") for c in columns]
    rows = a.select(F.struct(*whole).alias("row"), F.lit(1).alias("sign")).union(b.select(F.struct(*whole).alias("row"), F.lit(-1).alias("sign")))
    net = rows.groupBy("row").agg(F.sum("sign").alias("net")).filter("net <> 0")
    each = net.withColumn("again", F.explode(F.sequence(F.lit(1), F.abs("net").cast("int"))))
    return each.select(*[F.col(f"row.`{c}`") for c in columns], F.when(F.col("net") > 0, "first").otherwise("second").alias("only_in"))
