"""Joins: checked broadcast, salting, hot-key split, as-of, versions, intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.intervals import timeline
from tidemark.operators.ordered import place
from tidemark.session import cut

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a side is proven small in rows and in bytes (as text).

    Looks at no more than ``max_rows`` + 1 rows.
    """
    size = F.sum(F.length(F.to_json(F.struct(*df.columns))))
    n, width = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    return n <= max_rows and width <= max_bytes


def broadcast_checked(df: DataFrame, **bounds: int) -> DataFrame:
    """Hint a broadcast only when the side is proven small; else leave it to AQE."""
    return F.broadcast(df) if fits_broadcast(df, **bounds) else df


def entitled(df: DataFrame, grants: DataFrame, on: Sequence[str]) -> DataFrame:
    """Row-level filter: rows whose key is granted."""
    return df.join(grants.select(*on).distinct(), list(on), "left_semi")


def cascade(children: DataFrame, removed: DataFrame, fk: str, pk: str) -> DataFrame:
    """Children that stay when the removed parents take theirs with them."""
    return children.join(
        removed.select(F.col(pk).alias(fk)).distinct(), [fk], "left_anti"
    )


def salted_join(
    fact: DataFrame, dim: DataFrame, on: str, salts: int = 16, how: str = "inner"
) -> DataFrame:
    """Spread each key of the fact over ``salts`` tasks and copy the dimension.

    ``how`` is inner or left (fact side kept). The salt is a hash of the whole row, so
    a retried task draws the same salt. Equal rows share a salt; should one group of
    copies alone be too large for a task, AQE splits that partition of the join. The copies
    are never broadcast: Spark takes their size for that of one dimension.
    """
    if how not in ("inner", "left"):
        raise ValueError("only the fact side may be preserved")
    spread = fact.withColumn("_salt", F.pmod(F.xxhash64(*fact.columns), F.lit(salts)))
    copies = dim.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    )
    return spread.join(copies.hint("merge"), [on, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys holding at least ``share`` of the rows: never more than 1/share keys."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.count()
    return counts.filter(F.col("n") >= F.lit(share * total)).select(key)


def hybrid_join(
    fact: DataFrame, dim: DataFrame, on: str, share: float = 0.001, **bounds: int
) -> DataFrame:
    """Inner join: hot keys against a broadcast slice of the dimension, rest shuffled.

    The hot key list is bounded by 1/share. The dimension slice is broadcast only if
    it is proven small; otherwise the hot part is salted.
    """
    hot = F.broadcast(hot_keys(fact, on, share))
    # NULL keys match nothing in an inner join, so neither part needs them.
    busy = fact.join(hot, on, "left_semi")
    calm = fact.join(hot, on, "left_anti").filter(F.col(on).isNotNull())
    slice_ = dim.join(hot, on, "left_semi")
    if fits_broadcast(slice_, **bounds):
        joined = busy.join(F.broadcast(slice_), on)
    else:
        joined = salted_join(busy, slice_, on)
    rest = calm.join(dim.join(hot, on, "left_anti"), on)
    return joined.unionByName(rest)


def as_of_join(
    labels: DataFrame,
    features: DataFrame,
    key: str,
    at: str,
    tie: str,
    values: Sequence[str],
    **how,
) -> DataFrame:
    """For every label row the newest feature row of its key at or before its time.

    Both sides go through one ordered scan, so nothing later than the label is seen
    and the cost is one sort, whatever the number of feature rows per key.
    ``tie`` identifies rows on both sides and breaks equal times.
    """
    known = features.select(
        key, at, F.lit(0).alias("_side"), F.col(tie).alias("_tie"),
        F.struct(*values).alias("_known"),
    )
    rows = labels.select("*", F.struct(*labels.columns).alias("_label")).select(
        key, at, F.lit(1).alias("_side"), F.col(tie).alias("_tie"), "_label"
    )
    both = known.unionByName(rows, allowMissingColumns=True)
    ordered = place(both, [key], [at, "_side", "_tie"], **how)
    seen = ordered.latest(_value=F.col("_known")).df.filter(F.col("_side") == 1)
    return seen.select("_label.*", *[F.col("_value")[v].alias(f"last_{v}") for v in values])


def version_at(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    ident: str,
    **how,
) -> DataFrame:
    """The dimension version valid at the fact's date; half-open, NULL end is open.

    Where versions of a key overlap, the one that started last is valid, and an older
    one again once it has ended. The versions are laid out as a timeline without
    overlaps, and one as-of scan finds the fact's place in it: one sort, however many
    facts a key has, and the same way at every size. ``ident`` identifies facts.
    """
    extra = [c for c in dim.columns if c not in facts.columns]
    kind = dict(facts.dtypes)[at]
    # Read twice: the as-of scan measures its rows first.
    line = cut(timeline(dim, key, start, end, extra, kind)).withColumn("_id", F.lit(0).cast("long"))
    rows = facts.withColumn("_at", F.col(at)).withColumn("_id", F.col(ident))
    seen = as_of_join(rows, line, key, "_at", "_id", extra, **how)
    return seen.select(*facts.columns, *[F.col(f"last_{c}").alias(c) for c in extra])


def overlapping(
    spans: DataFrame, key: str, ident: str, start: str, end: str, **how
) -> DataFrame:
    """Rows of a key that start inside an earlier row's span (half-open, NULL = open).

    A running maximum of the ends replaces the self-join, so a key with many rows
    costs a sort and not a square. Each offending row is reported once, with the
    reaching earlier row.
    """
    far = F.coalesce(F.col(end), F.lit("9999-12-31").cast("date"))
    ordered = place(
        spans.withColumn("_end", far).withColumn("_id", F.col(ident)), [key], [start, "_id"], **how
    )
    reach = _running_reach(ordered)
    return reach.filter(F.col(start) < F.col("_reach._end")).select(
        key, F.col("_reach._id").alias(f"earlier_{ident}"), F.col(ident).alias(f"later_{ident}")
    )


def _running_reach(ordered):
    # max(struct) over earlier rows: keep the row with the furthest end seen so far.
    from pyspark.sql import Window

    d = ordered._df
    chunk = ["_chunk"] if ordered.chunked else []
    local = (
        Window.partitionBy(*ordered.keys, *chunk)
        .orderBy(*ordered.order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    span = F.struct("_end", "_id")
    if not ordered.chunked:
        return d.withColumn("_reach", F.max(span).over(local))
    from tidemark.operators.ordered import _Before

    carried = ordered._carried({"_s": F.max(span)}, {"_c": _Before(F.max, "_s")})
    # max() of two structs; greatest() needs one non-NULL side.
    return carried.withColumn(
        "_reach", F.greatest(F.max(span).over(local), F.col("_c"))
    ).drop("_c", "_chunk")


def also_bought(
    lines: DataFrame, basket: str, item: str, seeds: DataFrame
) -> DataFrame:
    """For each seed item, the other items found in the same baskets, with counts.

    Any number of seeds. A basket's items are compared only with the seeds it holds,
    never with each other; the join splits a basket that holds very many.
    """
    pairs = cut(lines.select(basket, item).distinct())
    holders = pairs.join(seeds.select(item).distinct(), item, "left_semi").withColumnRenamed(item, "seed")
    return (
        pairs.join(holders, basket)
        .select("seed", F.col(item).alias("other"))
        .filter("seed <> other")
        .groupBy("seed", "other")
        .agg(F.count("*").alias("baskets"))
    )


def influence(edges: DataFrame, follower: str, followed: str) -> DataFrame:
    """Followers plus a tenth of the followers' followers.

    Both hops use pre-aggregated degrees; edges are never joined with edges.
    """
    degree = edges.groupBy(F.col(followed).alias("node")).agg(F.count("*").alias("followers"))
    second = (
        edges.join(
            degree.select(F.col("node").alias(follower), F.col("followers").alias("_d")),
            follower,
            "left",
        )
        .groupBy(F.col(followed).alias("node"))
        .agg(F.sum(F.coalesce("_d", F.lit(0))).alias("second_hop"))
    )
    return degree.join(second, "node").withColumn(
        "influence", (F.col("followers") * 10 + F.col("second_hop")) / F.lit(10.0)
    )


def viral_posts(
    posts: DataFrame, likes: DataFrame, follows: DataFrame, min_likes=1000, hours=24
) -> DataFrame:
    """Posts with more than ``min_likes`` likes in time, most from non-followers."""
    early = likes.join(posts.select("post_id", "author_id", "posted_at"), "post_id").filter(
        (F.col("liked_at") >= F.col("posted_at"))
        & (F.col("liked_at") < F.col("posted_at") + F.expr(f"INTERVAL {hours} HOURS"))
    )
    known = follows.select(
        F.col("follower_id").alias("user_id"), F.col("followed_id").alias("author_id"),
        F.lit(1).alias("_f"),
    ).distinct()
    marked = early.join(known, ["user_id", "author_id"], "left")
    return (
        marked.groupBy("post_id")
        .agg(F.count("*").alias("likes"), F.count_if(F.col("_f").isNull()).alias("strangers"))
        .filter((F.col("likes") > min_likes) & (F.col("strangers") * 2 > F.col("likes")))
    )


def engagement(
    users: DataFrame, likes: DataFrame, comments: DataFrame, follows: DataFrame, top=10
) -> DataFrame:
    """(likes + comments) / followers per author; no followers gives NULL."""

    def per(df: DataFrame, who: str, name: str) -> DataFrame:
        return df.groupBy(F.col(who).alias("user_id")).agg(F.count("*").alias(name))

    out = users.select("user_id")
    for part in (
        per(likes, "author_id", "likes"),
        per(comments, "author_id", "comments"),
        per(follows, "followed_id", "followers"),
    ):
        out = out.join(part, "user_id", "left")
    out = out.fillna(0, ["likes", "comments", "followers"])
    rate = F.try_divide(
        (F.col("likes") + F.col("comments")).cast("double"), F.col("followers").cast("double")
    )
    return (
        out.withColumn("engagement_rate", rate)
        .orderBy(F.desc_nulls_last("engagement_rate"), "user_id")
        .limit(top)
    )


def covering(
    requests: DataFrame, accounts: DataFrame, key: str, account_key: str, amount: str, balance: str
) -> DataFrame:
    """Requests that some account row of the key can cover; rows never multiply.

    Accounts are reduced to their largest balance first, so an account number that
    occurs many times costs one row in the join.
    """
    best = accounts.groupBy(F.col(account_key).alias(key)).agg(F.max(balance).alias("_best"))
    return requests.join(best, key).filter(F.col(amount) <= F.col("_best")).drop("_best")
