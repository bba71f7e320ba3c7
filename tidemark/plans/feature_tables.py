"""Features, experiments and run-length time series."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import features as M
from tidemark.operators import runs as N
from tidemark.operators.joins import as_of_join
from tidemark.operators.ordered import exact_quantiles
from tidemark.operators.ranking import top_n_per_group
from tidemark.plans.frames import EVENTS_AS_OF, events
from tidemark.plans.registry import query, table
from tidemark.session import fresh_path, widen
from tidemark.sources.files import data_files

KINDS = ["view", "click", "purchase"]


def _span(days: int) -> str:
    return f"ts >= TIMESTAMP '2024-01-29' - INTERVAL {days} DAY AND ts < TIMESTAMP '2024-01-29'"


FEATURES = (
    "SELECT user_id, "
    + ", ".join(
        f"COUNT(*) FILTER (WHERE event_type = '{k}' AND {_span(d)}) AS {k}_{d}d" for d in (7, 30) for k in KINDS
    )
    + ", "
    + ", ".join(
        f"CAST(COALESCE(SUM(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase' AND {_span(d)}), 0) AS DOUBLE) AS spend_{d}d"
        for d in (7, 30)
    )
    + ", date_diff('day', CAST(MAX(ts) AS DATE), DATE '2024-01-29') AS days_since_last FROM events WHERE ts < TIMESTAMP '2024-01-29' GROUP BY 1"
)


@query("user_features", FEATURES)
def user_features(spark, sf):
    """Counts, spend and recency in 7 and 30 days, in one pass."""
    return M.user_features(events(spark, sf), EVENTS_AS_OF, KINDS)


@query(
    "versioned_features",
    """SELECT '2024-01-15' AS as_of, 'v2' AS feature_version, COUNT(DISTINCT user_id) AS users FROM events WHERE ts < TIMESTAMP '2024-01-15'
    UNION ALL SELECT '2024-01-29', 'v2', COUNT(DISTINCT user_id) FROM events WHERE ts < TIMESTAMP '2024-01-29'""",
)
def versioned_features(spark, sf):
    """Features recomputed for two past dates, stamped and kept apart."""
    out = None
    for day in (date(2024, 1, 15), date(2024, 1, 29)):
        one = M.feature_version(M.user_features(events(spark, sf), day, KINDS), day, "v2")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("as_of", "feature_version").agg(F.count("*").alias("users"))


@query(
    "training_set",
    """WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    f AS (SELECT event_id AS fid, user_id, ts, value FROM events WHERE event_type = 'click')
    SELECT l.event_id, arg_max(f.value, (f.ts, f.fid)) AS last_value, strftime(MAX(f.ts), '%Y-%m-%d %H:%M:%S') AS last_seen
    FROM l LEFT JOIN f ON l.user_id = f.user_id AND f.ts <= l.ts GROUP BY 1""",
)
def training_set(spark, sf):
    """Purchases with the last click before them, also with every user hot."""
    e = events(spark, sf)
    labels = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = e.filter("event_type = 'click'").select("event_id", "user_id", "ts", "value", F.col("ts").alias("seen"))
    out = as_of_join(labels, clicks, "user_id", "ts", "event_id", ["value", "seen"], mode="chunked")
    return out.select("event_id", "last_value", "last_seen")


@query(
    "recs_with_fallback",
    """WITH n AS (SELECT o_custkey AS c, l_partkey AS p, COUNT(*) AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1, 2),
    own AS (SELECT c, p FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY k DESC, p) AS r FROM n) WHERE r = 1),
    pop AS (SELECT l_partkey AS p FROM lineitem GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)
    SELECT c_custkey, COALESCE(own.p, (SELECT p FROM pop)) AS l_partkey, own.p IS NULL AS is_fallback FROM customer LEFT JOIN own ON c = c_custkey""",
)
def recs_with_fallback(spark, sf):
    """Each customer's most bought part, or the most popular one."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")
    )
    counts = lines.join(done, "l_orderkey").groupBy("c_custkey", "l_partkey").agg(F.count("*").alias("k"))
    own = top_n_per_group(counts, ["c_custkey"], [F.desc("k"), F.asc("l_partkey")], 1)
    popular = lines.groupBy("l_partkey").agg(F.count("*").alias("k")).orderBy(F.desc("k"), "l_partkey")
    return M.with_fallback(table(spark, sf, "customer"), own, popular, "c_custkey", "l_partkey")


PSI_EDGES = """n AS (SELECT value, row_number() OVER (ORDER BY value) AS r, COUNT(*) OVER () AS c FROM events WHERE ts < TIMESTAMP '2024-01-16'),
    q AS (SELECT k, MIN(value) FILTER (WHERE r * 10 >= c * k) AS e FROM n, range(1, 10) AS t(k) GROUP BY 1),
    b AS (SELECT CAST((SELECT COUNT(*) FROM q WHERE events.value > e) AS BIGINT) AS bin, COUNT(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS b,
    COUNT(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16') AS c FROM events GROUP BY 1)"""


@query("psi_bins", f"WITH {PSI_EDGES} SELECT bin, b, c FROM b")
def psi_bins(spark, sf):
    """Exact baseline deciles, and both halves of the month counted into them."""
    return _psi(spark, sf).select("bin", "b", "c")


@query(
    "psi",
    f"""WITH {PSI_EDGES}, s AS (SELECT greatest(CAST(b AS DOUBLE) / (SELECT SUM(b)::DOUBLE FROM b), 0.0001::DOUBLE) AS a,
    greatest(CAST(c AS DOUBLE) / (SELECT SUM(c)::DOUBLE FROM b), 0.0001::DOUBLE) AS z FROM b)
    SELECT ROUND(SUM((z - a) * ln(z / a)), 6) AS psi FROM s""",
)
def psi(spark, sf):
    return _psi(spark, sf).agg(F.round(F.sum("term"), 6).alias("psi"))


def _psi(spark, sf):
    e = events(spark, sf).select("ts", "value")
    first = F.col("ts") < F.lit(datetime(2024, 1, 16))
    cuts = exact_quantiles(e.filter(first), [], "value", [i / 10 for i in range(1, 10)]).first()
    return M.psi(e.filter(first), e.filter(~first), "value", list(cuts))


AB = """u AS (SELECT user_id, CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 2 AS variant,
    bool_or(event_type = 'purchase' AND value > 100) AS bought FROM events GROUP BY 1),
    m AS (SELECT variant, COUNT(*) AS users, COUNT(*) FILTER (WHERE bought) AS conversions FROM u GROUP BY 1)"""


def _ab(spark, sf):
    users = events(spark, sf).groupBy("user_id").agg(
        F.bool_or((F.col("event_type") == "purchase") & (F.col("value") > 100)).alias("bought")
    )
    return M.ab_metrics(users.withColumn("variant", M.assign_variant("user_id")), "variant", "bought")


@query("ab_metrics", f"WITH {AB} SELECT variant, users, conversions, CAST(conversions AS DOUBLE) / users AS rate FROM m")
def ab_metrics(spark, sf):
    return _ab(spark, sf)


@query(
    "ab_lift",
    f"""WITH {AB}, p AS (SELECT MAX(CASE variant WHEN 0 THEN users END)::DOUBLE AS n0, MAX(CASE variant WHEN 1 THEN users END)::DOUBLE AS n1,
    MAX(CASE variant WHEN 0 THEN conversions END)::DOUBLE AS c0, MAX(CASE variant WHEN 1 THEN conversions END)::DOUBLE AS c1 FROM m)
    SELECT ROUND((c1 / n1 - c0 / n0) / (c0 / n0), 6) AS lift, ROUND((c1 / n1 - c0 / n0) / sqrt((c0 + c1) / (n0 + n1) * (1 - (c0 + c1) / (n0 + n1)) * (1 / n0 + 1 / n1)), 6) AS z FROM p""",
)
def ab_lift(spark, sf):
    out = M.ab_lift(_ab(spark, sf), "variant")
    return out.select(F.round("lift", 6).alias("lift"), F.round("z", 6).alias("z"))


@query(
    "pii_counts",
    "SELECT "
    + ", ".join(
        f"CAST(SUM(len(regexp_extract_all(text, '{p}'))) AS BIGINT) AS {n}" for n, p in X.PII.items()
    )
    + " FROM documents",
)
def pii_counts(spark, sf):
    """Personal data found in whole texts."""
    counts = X.pii_counts(F.col("text"))
    return widen(table(spark, sf, "documents")).agg(*[F.sum(c).alias(n) for n, c in counts.items()])


def _hidden_sql():
    out = "text"
    for n, p in X.PII.items():
        out = f"regexp_replace({out}, '{p}', '<{n}>', 'g')"
    return out


@query("pii_hidden", f"SELECT doc_id, md5({_hidden_sql()}) AS hidden FROM documents")
def pii_hidden(spark, sf):
    return widen(table(spark, sf, "documents")).select("doc_id", F.md5(X.hide_pii(F.col("text"))).alias("hidden"))


@query(
    "ts_delta",
    """SELECT event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS delta_us FROM events""",
)
def ts_delta(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts")
    return N.deltas(rows, ["user_id"], "ts", "event_id").select("event_id", "delta_us")


RUNS = """s AS (SELECT user_id, ts, event_id, ROUND(value / 50, 0) AS v FROM events),
    f AS (SELECT *, CASE WHEN v IS DISTINCT FROM lag(v) OVER w THEN 1 ELSE 0 END AS turn FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    g AS (SELECT *, SUM(turn) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM f),
    r AS (SELECT user_id, MIN(ts) AS run_start, MAX(ts) AS run_end, MIN(v) AS run_value, COUNT(*) AS points FROM g GROUP BY user_id, island)"""


def _runs(spark, sf, **how):
    level = F.round(F.col("value") / 50, 0)
    rows = events(spark, sf).select("user_id", "ts", "event_id", "value")
    return N.encode(rows, ["user_id"], ["ts", "event_id"], level, **how)


@query(
    "rle",
    f"""WITH {RUNS} SELECT user_id, strftime(run_start, '%Y-%m-%d %H:%M:%S') AS run_start, strftime(run_end, '%Y-%m-%d %H:%M:%S') AS run_end, run_value, points FROM r""",
)
def rle(spark, sf):
    """Runs of the rounded level of each user's series."""
    return _runs(spark, sf).drop("island")


@query(
    "rounded_values",
    "SELECT event_id, ROUND(value, 1) AS v FROM events",
)
def rounded_values(spark, sf):
    """Two stored decimals rounded to one, before encoding."""
    return events(spark, sf).select("event_id", F.round(F.col("value"), 1).alias("v"))


@query(
    "rle_round_trip",
    """WITH h AS (SELECT user_id % 10 AS series, date_trunc('hour', ts) AS ts, MIN(event_type) AS value FROM events GROUP BY 1, 2)
    SELECT series, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, value FROM h""",
)
def rle_round_trip(spark, sf):
    """Hourly series encoded to runs and decoded to the same points."""
    hourly = events(spark, sf).groupBy(
        (F.col("user_id") % 10).alias("series"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")
    ).agg(F.min("event_type").alias("value"))
    from tidemark.operators.ordered import islands, place

    ordered = place(hourly, ["series"], ["ts"], mode="window")
    turn = ~F.col("_v").eqNullSafe(F.col("value")) | (F.col("ts") != F.col("_t") + F.expr("INTERVAL 1 HOUR"))
    runs = islands(ordered, turn, {"_v": F.col("value"), "_t": F.col("ts")}).df.groupBy("series", "island").agg(
        F.min("ts").alias("run_start"), F.max("ts").alias("run_end"), F.min("value").alias("run_value")
    )
    return N.decode(runs, ["series"], "1 HOUR")


@query(
    "rle_range",
    f"""WITH {RUNS} SELECT user_id, COUNT(*) AS runs, CAST(SUM(points) AS BIGINT) AS points FROM r
    WHERE run_end >= TIMESTAMP '2024-01-10' AND run_start <= TIMESTAMP '2024-01-20' GROUP BY 1""",
)
def rle_range(spark, sf):
    """A range query on runs without decoding them."""
    hit = N.in_range(_runs(spark, sf), datetime(2024, 1, 10), datetime(2024, 1, 20))
    return hit.groupBy("user_id").agg(F.count("*").alias("runs"), F.sum("points").alias("points"))


@query("rle_size")
def rle_size(spark, sf):
    """Rows and bytes of the points and of their runs, both as Parquet files."""
    a, b = fresh_path(spark, "points"), fresh_path(spark, "runs")
    events(spark, sf).select("user_id", "ts", F.round(F.col("value") / 50, 0).alias("v")).write.parquet(a)
    _runs(spark, sf).select("user_id", "run_start", "run_end", "run_value").write.parquet(b)
    out = None
    for label, path in (("points", a), ("runs", b)):
        one = data_files(spark, path).agg(F.lit(label).alias("form"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
        out = one if out is None else out.unionByName(one)
    return out
