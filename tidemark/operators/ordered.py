"""Ordered scans over keyed rows that stay parallel when one key is hot.

A plain ``Window.partitionBy(key)`` puts a whole key into one task. ``place``
measures the largest key first. While every key fits, the plain window is used
(one shuffle); both ways give the same rows. Without a key, and otherwise, the rows are range-partitioned on ``(key, order)``, so a
hot key is spread over many chunks; each chunk is scanned on its own and the state
carried in from earlier chunks is added. A chunk can only continue the key that the
chunk before it ended with, so the carry table holds at most one row per chunk and is
safe to broadcast. The range placement is checkpointed: the sampled boundaries must
be the same for the rows and for the carry.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut

HOT_ROWS = 2_000_000
CHUNK_ROWS = 500_000
MOST_CHUNKS = 50_000
_CHUNK = "_chunk"


class Ordered:
    """Rows with a key and a total ascending order; methods append columns."""

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        chunked: bool,
        spanning: DataFrame | None = None,
    ):
        self._df = df
        self.keys = list(keys)
        self.order = list(order)
        self.chunked = chunked
        self._spanning = spanning

    @property
    def df(self) -> DataFrame:
        return self._df.drop(_CHUNK)

    def _with(self, df: DataFrame) -> Ordered:
        return Ordered(df, self.keys, self.order, self.chunked, self._spanning)

    def map(self, step: Callable[[DataFrame], DataFrame]) -> Ordered:
        """Apply a row-wise projection or filter; it must keep keys and order."""
        return self._with(step(self._df))

    def _window_keys(self) -> list[str]:
        return self.keys + ([_CHUNK] if self.chunked else [])

    def _window(self):
        return Window.partitionBy(*self._window_keys()).orderBy(*self.order)

    def _edges(self, summary: dict[str, Column]) -> DataFrame:
        """One row of ``summary`` for each chunk of the keys that lie in several chunks."""
        rows = self._df
        if self._spanning is not None:
            # Only keys that lie in several chunks have anything to carry.
            rows = rows.join(F.broadcast(self._spanning), self._same_key("_s"), "left_semi")
        return rows.groupBy(*self.keys, _CHUNK).agg(*[c.alias(n) for n, c in summary.items()])

    def _attach(self, edges: DataFrame, names: Sequence[str]) -> DataFrame:
        """The rows with the columns ``names`` of their chunk's edge row."""
        edges = edges.select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)], F.col(_CHUNK).alias("_kc"), *names
        )
        match = (F.col(_CHUNK) == F.col("_kc")) & self._same_key("_k")
        joined = self._df.join(F.broadcast(edges), match, "left")
        return joined.drop("_kc", *[f"_k{i}" for i in range(len(self.keys))])

    def _carried(self, summary: dict[str, Column], carry: dict[str, Column]) -> DataFrame:
        """Join to each row what the other chunks of its key contribute."""
        by_key = Window.partitionBy(*self.keys).orderBy(_CHUNK)
        edges = self._edges(summary).select(
            *self.keys, _CHUNK, *[_over(c, by_key).alias(n) for n, c in carry.items()]
        )
        return self._attach(edges, list(carry))

    def _same_key(self, prefix: str) -> Column:
        out = F.lit(True)
        for i, k in enumerate(self.keys):
            out = out & F.col(k).eqNullSafe(F.col(f"{prefix}{i}"))
        return out

    def _neighbour(self, cols: dict[str, Column], forward: bool) -> Ordered:
        shift = F.lead if forward else F.lag
        tmp = {f"_in_{n}": c for n, c in cols.items()}
        base = self._df.withColumns(tmp)
        window = self._window()
        if not self.chunked:
            out = base.withColumns({n: shift(f"_in_{n}").over(window) for n in cols})
            return self._with(out.drop(*tmp))
        at = F.struct(*self.order)
        row = F.struct(*tmp)
        pick = F.min_by if forward else F.max_by
        base = self._with(base)._carried({"_edge": pick(row, at)}, {"_carry": shift("_edge")})
        at_edge = shift(F.lit(True)).over(window).isNull()
        out = base.withColumns(
            {
                n: F.when(at_edge, F.col("_carry")[f"_in_{n}"]).otherwise(
                    shift(f"_in_{n}").over(window)
                )
                for n in cols
            }
        )
        return self._with(out.drop("_carry", *tmp))

    def previous(self, **cols: Column) -> Ordered:
        """Values of the row before in the key; NULL on the first row."""
        return self._neighbour(cols, forward=False)

    def following(self, **cols: Column) -> Ordered:
        """Values of the row after in the key; NULL on the last row."""
        return self._neighbour(cols, forward=True)

    def running_sum(self, **cols: Column) -> Ordered:
        """Sum of each column over the key's rows up to and including this one."""
        upto = self._window().rowsBetween(Window.unboundedPreceding, 0)
        tmp = {f"_in_{n}": c for n, c in cols.items()}
        base = self._df.withColumns(tmp)
        if not self.chunked:
            out = base.withColumns({n: F.sum(f"_in_{n}").over(upto) for n in cols})
            return self._with(out.drop(*tmp))
        base = self._with(base)._carried(
            {f"_s_{n}": F.sum(f"_in_{n}") for n in cols},
            {f"_c_{n}": _Before(F.sum, f"_s_{n}") for n in cols},
        )
        out = base.withColumns(
            {
                n: _plus(F.sum(f"_in_{n}").over(upto), F.col(f"_c_{n}"))
                for n in cols
            }
        )
        return self._with(out.drop(*tmp, *[f"_c_{n}" for n in cols]))

    def latest(self, **cols: Column) -> Ordered:
        """The last non-NULL value of each column up to and including this row."""
        upto = self._window().rowsBetween(Window.unboundedPreceding, 0)
        tmp = {f"_in_{n}": c for n, c in cols.items()}
        base = self._df.withColumns(tmp)
        if not self.chunked:
            out = base.withColumns(
                {n: F.last(f"_in_{n}", True).over(upto) for n in cols}
            )
            return self._with(out.drop(*tmp))
        at = F.struct(*self.order)
        base = self._with(base)._carried(
            {
                f"_s_{n}": F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), at))
                for n in cols
            },
            {f"_c_{n}": _Before(_last_known, f"_s_{n}") for n in cols},
        )
        out = base.withColumns(
            {
                n: F.coalesce(F.last(f"_in_{n}", True).over(upto), F.col(f"_c_{n}"))
                for n in cols
            }
        )
        return self._with(out.drop(*tmp, *[f"_c_{n}" for n in cols]))


class _Before:
    """An aggregate over the key's earlier chunks only."""

    def __init__(self, function: Callable[[str], Column], column: str):
        self.function, self.column = function, column


def _last_known(name: str) -> Column:
    return F.last(name, True)


def _over(value: Column | _Before, window) -> Column:
    if isinstance(value, _Before):
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        return value.function(value.column).over(earlier)
    return value.over(window)


def _plus(local: Column, carry: Column) -> Column:
    return F.when(carry.isNull(), local).otherwise(F.coalesce(local + carry, carry))


def place(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    mode: str = "auto",
    hot_rows: int = HOT_ROWS,
    chunks: int | None = None,
) -> Ordered:
    """Prepare rows for ordered scans. ``order`` must be total inside a key.

    ``mode`` is ``auto`` (measure the largest key), ``window`` or ``chunked``. Give
    ``window`` where rows per key are bounded by construction, such as one row per key
    and month; it saves measuring. ``chunks`` fixes the number of ranges; by default
    the measured row count decides, or AQE where nothing was measured.
    """
    if mode == "auto" and not keys:
        mode = "chunked"  # a window without keys is one task, whatever the size
    if mode == "auto":
        sizes = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
        mode = "chunked" if (sizes[0] or 0) > hot_rows else "window"
        if mode == "chunked" and chunks is None:
            usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            wanted = math.ceil(sizes[1] / CHUNK_ROWS)
            chunks = max(usual, min(wanted, MOST_CHUNKS))
    if mode == "window":
        return Ordered(df, keys, order, False)
    by = [F.col(c) for c in (*keys, *order)]
    spread = df.repartitionByRange(chunks, *by) if chunks else df.repartitionByRange(*by)
    laid = cut(spread.withColumn(_CHUNK, F.spark_partition_id()))
    return Ordered(laid, keys, order, True, _spanning_keys(laid, keys))


def _spanning_keys(laid: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The keys that lie in more than one chunk: fewer than there are chunks."""
    if not keys:
        return None
    named = [F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)]
    spans = laid.groupBy(*named).agg(F.min(_CHUNK).alias("lo"), F.max(_CHUNK).alias("hi"))
    return cut(spans.filter("lo < hi").drop("lo", "hi"))


def with_row_number(ordered: Ordered, name: str = "rn") -> Ordered:
    return ordered.running_sum(**{name: F.lit(1).cast("long")})


def islands(ordered: Ordered, starts: Column, watch: dict[str, Column], name="island"):
    """Number the runs of each key.

    ``watch`` names values of the previous row; ``starts`` is a condition over the
    row and those names. The first row of a key always starts a run.
    """
    first = {"_has_prev": F.lit(True)}
    flagged = ordered.previous(**first, **watch).map(
        lambda d: d.withColumn(
            "_start",
            F.when(F.col("_has_prev").isNull() | starts, 1).otherwise(0).cast("long"),
        )
    )
    numbered = flagged.running_sum(**{name: F.col("_start")})
    return numbered.map(lambda d: d.drop("_has_prev", "_start", *watch))


def global_ranks(
    df: DataFrame, measure: str, tie: Sequence[str], descending=True, **how
) -> DataFrame:
    """row_number, rank and dense_rank over the whole table, never in one task."""
    return ranks(df, [], measure, tie, descending, **how)


def ranks(
    df: DataFrame, keys: Sequence[str], measure: str, tie: Sequence[str], descending=True, **how
) -> DataFrame:
    """row_number, rank and dense_rank inside each key; NULL measures come last."""
    sign = -F.col(measure) if descending else F.col(measure)
    marked = df.withColumn("_m", sign).withColumn("_null", F.col(measure).isNull())
    ordered = place(marked, keys, ["_null", "_m", *tie], **how)
    rows = ordered._df.withColumn("row_num", F.row_number().over(ordered._window()))
    within = Window.partitionBy(*ordered._window_keys()).orderBy("_null", "_m")
    rows = rows.withColumns({"rank": F.rank().over(within), "dense_rank": F.dense_rank().over(within)})
    rows = rows.withColumns({c: F.col(c).cast("long") for c in ("row_num", "rank", "dense_rank")})
    if ordered.chunked:
        rows = _ranks_of_key(ordered._with(rows))
    return ordered._with(rows).df.drop("_m", "_null")


def _ranks_of_key(local: Ordered) -> DataFrame:
    """Ranks inside the chunks turned into ranks inside the keys, by one carry.

    A chunk adds its rows and distinct measures to the later ones; if it begins with the
    measure that the chunk before ended with, that measure counts once and keeps its rank.
    """
    at = F.struct("_null", "_m")
    edges = local._edges(
        {
            "_rows": F.max("row_num"),
            "_values": F.max("dense_rank"),
            "_last_rank": F.max("rank"),
            "_first": F.min(at),
            "_last": F.max(at),
        }
    )
    by_key = Window.partitionBy(*local.keys).orderBy(_CHUNK)
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    edges = edges.withColumns({"_same": F.coalesce(F.lag("_last").over(by_key) == F.col("_first"), F.lit(False)), "_before": so_far("_rows")})
    begun = F.when(~F.col("_same") | (F.col("_last_rank") > 1), F.col("_before") + F.col("_last_rank"))
    edges = edges.withColumns({"_new": F.col("_values") - F.col("_same").cast("long"), "_begun": begun})
    edges = edges.withColumns(
        {
            "_seen": so_far("_new") - F.col("_same").cast("long"),
            "_tied": F.when(F.col("_same"), F.last("_begun", True).over(earlier)),
        }
    )
    rows = local._attach(edges, ["_before", "_seen", "_tied"])
    before, seen = F.coalesce("_before", F.lit(0)), F.coalesce("_seen", F.lit(0))
    rank = F.when((F.col("rank") == 1) & F.col("_tied").isNotNull(), F.col("_tied")).otherwise(F.col("rank") + before)
    return rows.withColumns(
        {"row_num": F.col("row_num") + before, "rank": rank, "dense_rank": F.col("dense_rank") + seen}
    ).drop("_before", "_seen", "_tied")


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], **how
) -> DataFrame:
    """Per key, the smallest value whose cumulative share reaches each probability.

    Ranks come from the ordered scan, so no group's values are held in memory.
    Probabilities are given in thousandths to keep the rank arithmetic in integers.
    """
    counted = cut(
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    )
    ordered = place(counted, keys, [value], **how).running_sum(_upto=F.col("_n"))
    rows = ordered.df
    totals = counted.groupBy(*keys).agg(F.sum("_n").alias("_all"))
    rows = join_back(rows, totals, keys) if keys else _attach_single(rows, totals)
    return rows.groupBy(*keys).agg(
        *[
            F.min(
                F.when(
                    F.col("_upto") * 1000 >= F.col("_all") * int(round(p * 1000)),
                    F.col(value),
                )
            ).alias(f"q{int(round(p * 1000))}")
            for p in probs
        ]
    )


def join_back(rows: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of rows with one row per key; a NULL key meets the NULL key."""
    named = totals.withColumnsRenamed({k: f"_b{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & rows[k].eqNullSafe(named[f"_b{i}"])
    return rows.join(named, same).drop(*[f"_b{i}" for i in range(len(keys))])


def _attach_single(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    value = one_row.first()
    # A number from Python is an integer if it fits one; products with it would overflow.
    return rows.withColumns({c: F.lit(value[c]).cast(one_row.schema[c].dataType) for c in one_row.columns})
