"""Streaming jobs over the landed event files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import normal_key, ratio
from tidemark.operators.versions import Dataset
from tidemark.plans.frames import COSTS, events
from tidemark.plans.registry import query, table
from tidemark.session import fresh_path
from tidemark.streaming import state as ST
from tidemark.streaming import streams as S

DELAY = "7 days"


def _stream(spark, sf, **options):
    return S.landed(spark, sf, glob="events.parquet", **options)


def _local(name):
    return F.col(name).cast("timestamp_ntz").alias(name)


@query("landed_files", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def landed_files(spark, sf):
    """A continuous load of landed files, then a batch count."""
    rows = S.drain(_stream(spark, sf).select("event_id", "event_type"), "landed")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"))


HOURLY = """h AS (SELECT date_trunc('hour', ts) AS s, COUNT(*) AS n, COUNT(*) FILTER (WHERE event_type = 'error') AS errors,
    CAST(COUNT(*) FILTER (WHERE event_type = 'error') AS DOUBLE) / COUNT(*) AS error_rate FROM events GROUP BY 1)"""


@query(
    "stream_hourly",
    f"""WITH {HOURLY} SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, n, errors, error_rate FROM h
    WHERE s + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 7 DAY""",
)
def stream_hourly(spark, sf):
    """Windows closed by a seven-day watermark, in append mode."""
    out = S.drain(S.hourly_health(_stream(spark, sf).withWatermark("ts", DELAY)), "hourly")
    return out.select(_local("window_start"), "n", "errors", ratio(F.col("errors"), F.col("n")).alias("error_rate"))


@query("batch_hourly", f"WITH {HOURLY} SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, n, errors, error_rate FROM h")
def batch_hourly(spark, sf):
    """The same function on the batch table."""
    return S.hourly_health(S.zoned(events(spark, sf))).select(_local("window_start"), "n", "errors", ratio(F.col("errors"), F.col("n")).alias("error_rate"))


@query(
    "active_sliding",
    """WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS s, user_id FROM events UNION ALL SELECT time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE, user_id FROM events)
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, COUNT(*) AS n, COUNT(DISTINCT user_id) AS users FROM w GROUP BY 1""",
)
def active_sliding(spark, sf):
    """Events and active users of sliding ten-minute windows."""
    return S.active_users(S.zoned(events(spark, sf))).select(_local("window_start"), "n", "users")


@query(
    "hourly_features",
    """WITH c AS (SELECT date_trunc('hour', ts) AS s, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY n DESC, event_type) AS place FROM c)
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(place AS BIGINT) AS place, event_type, n FROM r WHERE place <= 3""",
)
def hourly_features(spark, sf):
    """The three most used features of each hour."""
    return S.top_per_hour(S.zoned(events(spark, sf))).select(_local("window_start"), "place", "event_type", "n")


@query(
    "stream_top_features",
    """WITH c AS (SELECT date_trunc('hour', ts) AS s, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY n DESC, event_type) AS place FROM c)
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(place AS BIGINT) AS place, event_type, n FROM r WHERE place <= 3
    AND s + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 7 DAY""",
)
def stream_top_features(spark, sf):
    """The three most used features of each closed hour, from one sketch an hour in the state."""
    counters = S.drain(S.feature_counters(_stream(spark, sf).withWatermark("ts", DELAY)), "features")
    return S.top_items(counters).select(_local("window_start"), "place", F.col("item").alias("event_type"), "n")


@query(
    "stream_sessions",
    """WITH f AS (SELECT user_id, ts, event_id, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    g AS (SELECT *, SUM(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM f),
    r AS (SELECT user_id, MIN(ts) AS a, MAX(ts) + INTERVAL 30 MINUTE AS b, COUNT(*) AS points FROM g GROUP BY user_id, k)
    SELECT user_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS session_start, points FROM r WHERE b <= (SELECT MAX(ts) FROM events) - INTERVAL 7 DAY""",
)
def stream_sessions(spark, sf):
    """Sessions closed by the watermark."""
    out = S.drain(S.session_windows(_stream(spark, sf).withWatermark("ts", DELAY)), "sessions")
    return out.select("user_id", _local("session_start"), "points")


@query("stream_dedup", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def stream_dedup(spark, sf):
    """Every event is sent twice; one copy of each is kept."""
    sent = _stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    kept = S.first_copies(sent, ["event_id"], "30 days").select("event_id", "event_type")
    return S.drain(kept, "dedup").groupBy("event_type").agg(F.count("*").alias("n"))


METRICS = """SELECT user_id, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
    strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_seen FROM events GROUP BY 1"""


def _user_dataset(spark):
    data = Dataset(spark, fresh_path(spark, "users"))
    schema = T.StructType(
        [
            T.StructField("user_id", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("total", T.DecimalType(28, 2)),
            T.StructField("last_seen", T.TimestampType()),
        ]
    )
    data.create(schema)
    return data


@query("user_metrics", METRICS)
def user_metrics(spark, sf):
    """Changed users of each batch are upserted into a table, once per batch id."""
    data = _user_dataset(spark)
    step = S.upsert_once(data, "metrics", ["user_id"])
    S.drain_each(S.user_metrics(_stream(spark, sf)), "metrics", step, mode="update")
    return data.read().select("user_id", "n", "total", _local("last_seen"))


@query(
    "dual_write",
    """SELECT 'table' AS sink, COUNT(DISTINCT user_id) AS users FROM events UNION ALL SELECT 'files', COUNT(DISTINCT user_id) FROM events""",
)
def dual_write(spark, sf):
    """One batch to a table and to files; a replayed batch changes neither."""
    data, path = _user_dataset(spark), fresh_path(spark, "sink")
    step = S.upsert_once(data, "dual", ["user_id"], then=S.folder_per_batch(path))

    def replayed(batch, batch_id):
        step(batch, batch_id)
        step(batch, batch_id)

    S.drain_each(S.user_metrics(_stream(spark, sf)), "dual", replayed, mode="update")
    files = spark.read.schema("user_id long, batch int").parquet(path)
    return data.read().agg(F.lit("table").alias("sink"), F.count("*").alias("users")).unionByName(
        files.agg(F.lit("files").alias("sink"), F.count("*").alias("users"))
    )


@query("exactly_once", "SELECT COUNT(*) AS n, COUNT(DISTINCT event_id) AS events FROM events")
def exactly_once(spark, sf):
    """Stopped and started again on its checkpoint, with the batch replayed."""
    data = Dataset(spark, fresh_path(spark, "once"))
    data.create(T.StructType([T.StructField("event_id", T.LongType())]))
    checkpoint = fresh_path(spark, "once-checkpoint")
    step = S.append_once(data, "once")

    def replayed(batch, batch_id):
        step(batch, batch_id)
        step(batch, batch_id)

    for _ in range(2):
        S.drain_each(_stream(spark, sf).select("event_id"), "once", replayed, checkpoint=checkpoint)
    return data.read().agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("events"))


@query(
    "topic_enrich",
    """SELECT c_mktsegment AS segment, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events JOIN customer ON user_id = c_custkey GROUP BY 1""",
)
def topic_enrich(spark, sf):
    """Events enriched with a profile table and written out."""
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    rows = S.drain(S.enriched(_stream(spark, sf).select("event_id", "user_id", "value"), people, "user_id"), "enrich")
    return rows.groupBy("segment").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))


@query(
    "stream_stream_join",
    """SELECT a.event_id, b.event_id AS click_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts
    AND b.ts <= a.ts + INTERVAL 20 MINUTE WHERE a.event_type = 'view' AND b.event_type = 'click'""",
)
def stream_stream_join(spark, sf):
    """Clicks within twenty minutes after a view of the same user."""
    views = _stream(spark, sf).filter("event_type = 'view'").select("event_id", "user_id", "ts")
    clicks = _stream(spark, sf).filter("event_type = 'click'").select(
        F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts")
    )
    both = S.matched_streams(views, clicks, "user_id", "ts", "click_ts", "20 MINUTES", "30 days")
    return S.drain(both.select("event_id", "click_id"), "join")


@query(
    "stream_changes",
    """WITH last AS (SELECT user_id, arg_max(event_type, event_id) AS t, arg_max(value, event_id) AS value FROM events GROUP BY 1)
    SELECT c_custkey AS user_id, c_acctbal AS value FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM last)
    UNION ALL SELECT user_id, value FROM last WHERE t <> 'error'""",
)
def stream_changes(spark, sf):
    """Change records applied to a table as they land."""
    data = Dataset(spark, fresh_path(spark, "target"))
    target = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value"))
    data.append(target)
    action = F.when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    log = _stream(spark, sf).select("user_id", "value", "event_id", action.alias("action"))
    S.drain_each(log, "changes", S.apply_once(data, "changes", ["user_id"], "event_id", "action"))
    return data.read()


@query("late_rows", """SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE ts < TIMESTAMP '2024-01-30' - INTERVAL 7 DAY) AS too_late FROM events""")
def late_rows(spark, sf):
    """How many rows would be too late if all arrived on the last day."""
    rows = S.zoned(events(spark, sf)).withColumn("arrival", F.lit("2024-01-30").cast("timestamp"))
    return S.late_rows(rows, "arrival", "ts", "7 DAYS")


@query(
    "rate_breaches",
    """SELECT user_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start, COUNT(*) AS requests FROM events
    GROUP BY 1, 2 HAVING COUNT(*) > 1""",
)
def rate_breaches(spark, sf):
    """Users with more than one request in a minute."""
    return S.rate_breaches(S.zoned(events(spark, sf)), limit=1).select("user_id", _local("window_start"), "requests")


@query("capped_intake", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def capped_intake(spark, sf):
    """One file per batch during a spike; nothing is lost."""
    path = fresh_path(spark, "spike")
    events(spark, sf).repartitionByRange(4, "ts").write.parquet(path)
    rows = S.drain(S.landed(spark, path, files_per_batch=1).select("event_id", "event_type"), "spike")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "spike_alerts",
    f"""WITH {COSTS}, d AS (SELECT team, date, SUM(cost) AS cost FROM costs GROUP BY 1, 2)
    SELECT a.team, strftime(a.date, '%Y-%m-%d') AS date, CAST(a.cost - b.cost AS DOUBLE) / CAST(b.cost AS DOUBLE) AS rise
    FROM d a JOIN d b ON a.team = b.team AND a.date = b.date + 1 WHERE CAST(a.cost - b.cost AS DOUBLE) / CAST(b.cost AS DOUBLE) > 0.3""",
)
def spike_alerts(spark, sf):
    """Daily sums kept by the stream, and the days that cost 30 percent more."""
    orders = S.landed(
        spark, sf, "o_custkey long, o_totalprice double, o_orderdate timestamp_ntz", "orders.parquet", ts=None
    )
    teams = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("team"))
    rows = S.enriched(orders, teams, "o_custkey").select(
        "team", F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").cast("decimal(18,2)").alias("cost")
    )
    daily, alerts = Dataset(spark, fresh_path(spark, "daily")), Dataset(spark, fresh_path(spark, "alerts"))
    team, day = T.StructField("team", T.StringType()), T.StructField("date", T.DateType())
    daily.create(T.StructType([team, day, T.StructField("cost", T.DecimalType(28, 2))]))
    alerts.create(T.StructType([team, day, T.StructField("rise", T.DoubleType())]))
    S.drain_each(rows, "alerts", S.spike_alerts(daily, alerts, ["team"]))
    return alerts.read()


@query("incremental_dedup", "SELECT COUNT(DISTINCT md5(lower(trim(text)))) AS kept FROM documents")
def incremental_dedup(spark, sf):
    """Documents deduplicated as they land, against the keys already known."""
    data = Dataset(spark, fresh_path(spark, "known"))
    data.create(T.StructType([T.StructField("k", T.StringType()), T.StructField("doc_id", T.LongType())]))
    docs = S.landed(spark, sf, "doc_id long, text string", "documents.parquet", ts=None)

    def step(batch, batch_id):
        keyed = batch.select(normal_key("text").alias("k"), "doc_id")
        data.append(S.new_only(keyed, data.read(), "k"), batch=f"docs-{batch_id}")

    S.drain_each(docs, "known", step)
    return data.read().agg(F.count("*").alias("kept"))


@query(
    "same_feature",
    f"{METRICS.replace('SELECT user_id', 'SELECT user_id, true AS same', 1)}",
)
def same_feature(spark, sf):
    """A user feature from batch and from stream, compared row by row."""
    batch = S.user_metrics(S.zoned(events(spark, sf)))
    data = _user_dataset(spark)
    S.drain_each(S.user_metrics(_stream(spark, sf)), "same", S.upsert_once(data, "same", ["user_id"]), mode="update")
    live = data.read().select("user_id", F.struct("n", "total", "last_seen").alias("live"))
    joined = batch.join(live, "user_id", "left")
    same = F.struct("n", "total", "last_seen").eqNullSafe(F.col("live"))
    return joined.select("user_id", same.alias("same"), "n", "total", _local("last_seen"))


@query(
    "user_streaks",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS c FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2),
    g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS run FROM d),
    r AS (SELECT user_id, run, COUNT(*) AS days, MAX(day) AS last FROM g GROUP BY 1, 2)
    SELECT user_id, strftime(MAX(last), '%Y-%m-%d') AS day, arg_max(days, last) AS streak, MAX(days) AS longest,
    (SELECT CAST(SUM(c) AS BIGINT) FROM d WHERE d.user_id = r.user_id) AS n FROM r GROUP BY 1""",
)
def user_streaks(spark, sf):
    """Days in a row per user from the stream's keyed state, as last told."""
    told = S.drain(ST.streaks(_stream(spark, sf), DELAY, idle_days=60), "streaks")
    return ST.last_streaks(told).withColumn("day", F.date_from_unix_date("day"))
