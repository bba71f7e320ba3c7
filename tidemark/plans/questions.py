"""Vector retrieval and question-log analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions.columns import normal_key
from tidemark.operators import retrieval as R
from tidemark.plans.registry import query, table
from tidemark.session import cut

DIMS = 64

CENTROIDS = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    u AS (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM e),
    a AS (SELECT label, i, AVG(x) AS x FROM u GROUP BY 1, 2),
    q AS (SELECT label, list(x ORDER BY i) AS v FROM a GROUP BY 1)"""


def _questions(spark, sf):
    """One question per category: the mean vector of the category."""
    return R.mean_vectors(table(spark, sf, "embeddings"), "label", "embedding", DIMS).select(
        F.col("label").cast("long").alias("question_id"), "embedding", "label"
    )


TOP = """s AS (SELECT CAST(q.label AS BIGINT) AS question_id, vec_id, list_cosine_similarity(e.v, q.v) AS sim FROM q, e {where}),
    t AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY sim DESC, vec_id) AS rank FROM s)"""


@query(
    "vector_topk",
    f"WITH {CENTROIDS}, {TOP.format(where='')} SELECT question_id, vec_id, ROUND(sim, 4) AS similarity, rank FROM t WHERE rank <= 10",
)
def vector_topk(spark, sf):
    """The ten most similar vectors for every question at once."""
    hits = R.nearest(table(spark, sf, "embeddings"), _questions(spark, sf), 10)
    return hits.withColumn("similarity", F.round("similarity", 4))


@query(
    "vector_topk_label",
    f"WITH {CENTROIDS}, {TOP.format(where='WHERE e.label = q.label')} SELECT question_id, vec_id, ROUND(sim, 4) AS similarity, rank FROM t WHERE rank <= 5",
)
def vector_topk_label(spark, sf):
    """The same inside the question's own category."""
    hits = R.nearest(table(spark, sf, "embeddings"), _questions(spark, sf), 5, category="label")
    return hits.withColumn("similarity", F.round("similarity", 4))


@query(
    "cosine_pairs",
    f"""WITH {CENTROIDS} SELECT vec_id, ROUND(list_cosine_similarity(e.v, q.v), 4) AS similarity FROM e JOIN q USING (label)""",
)
def cosine_pairs(spark, sf):
    """Every vector against the mean of its category, as a Catalyst expression."""
    own = _questions(spark, sf).select("label", F.col("embedding").alias("mean"))
    rows = table(spark, sf, "embeddings").join(own, "label")
    return rows.select("vec_id", F.round(R.cosine(F.col("embedding"), F.col("mean")), 4).alias("similarity"))


HYBRID = f"""{CENTROIDS}, {TOP.format(where='')}, s2 AS (SELECT CAST(q.label AS BIGINT) AS question_id, vec_id, list_cosine_similarity(e.v, q.v) AS sim
    FROM q JOIN e USING (label)), t2 AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY sim DESC, vec_id) AS rank FROM s2),
    b AS (SELECT question_id, vec_id, 0 AS src, rank FROM t WHERE rank <= 10 UNION ALL SELECT question_id, vec_id, 1, rank FROM t2 WHERE rank <= 10),
    f AS (SELECT question_id, vec_id, MIN(src * 1000 + rank) AS pos FROM b GROUP BY 1, 2),
    h AS (SELECT question_id, vec_id, row_number() OVER (PARTITION BY question_id ORDER BY pos, vec_id) AS position FROM f)"""


def _hybrid(spark, sf):
    vectors, asked = table(spark, sf, "embeddings"), _questions(spark, sf)
    hits = cut(R.nearest_both(vectors, asked, 10, "label"))
    parts = [hits.filter(c).select("question_id", "vec_id", "rank") for c in ("NOT inside", "inside")]
    return R.hybrid(*parts, "question_id", "vec_id", 5)


@query("hybrid_topk", f"WITH {HYBRID} SELECT question_id, vec_id, position FROM h WHERE position <= 5")
def hybrid_topk(spark, sf):
    """Semantic hits, then category hits, merged; the first five."""
    return _hybrid(spark, sf)


@query(
    "contexts",
    f"""WITH {HYBRID} SELECT question_id, md5(string_agg(text, chr(10) || chr(10) ORDER BY position)) AS context_md5
    FROM h JOIN documents ON doc_id = vec_id WHERE position <= 5 GROUP BY 1""",
)
def contexts(spark, sf):
    """The hits' whole texts as one context per question (compared by md5)."""
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    out = R.contexts(_hybrid(spark, sf).join(texts, "vec_id"), "question_id", "position", "text")
    return out.select("question_id", F.md5("context").alias("context_md5"))


def _like_any(words):
    return "(" + " OR ".join(f"contains(lower(text), '{w}')" for w in words) + ")"


@query(
    "question_categories",
    "SELECT conv_id, turn, COALESCE(NULLIF(concat_ws(',', "
    + ", ".join(f"CASE WHEN {_like_any(ws)} THEN '{c}' END" for c, ws in X.CATEGORY_WORDS.items())
    + f"), ''), '{','.join(X.CATEGORY_WORDS)}') AS categories FROM conversations",
)
def question_categories(spark, sf):
    cats = F.array_join(X.categories(F.col("text")), ",")
    return table(spark, sf, "conversations").select("conv_id", "turn", cats.alias("categories"))


@query(
    "knowledge_rows",
    """SELECT category || '_' || i AS doc_id, category, COUNT(*) AS n FROM (SELECT 'role' AS category, 0 AS i FROM conversations
    UNION ALL SELECT 'text', 0 FROM conversations UNION ALL SELECT 'text', 1 FROM conversations) GROUP BY 1, 2""",
)
def knowledge_rows(spark, sf):
    """Arrays per category become (id, category, text) rows."""
    base = table(spark, sf, "conversations").select(
        F.array("role").alias("role"), F.array("text", F.upper("text")).alias("text")
    )
    return R.knowledge_rows(base, ["role", "text"]).groupBy("doc_id", "category").agg(F.count("*").alias("n"))


def _sql_checks():
    parts = [f"CASE WHEN regexp_matches(text, '(?i)\\b{v}\\b') THEN 'Forbidden keyword: {v}' END" for v in X.FORBIDDEN_VERBS]
    parts += [
        "CASE WHEN NOT regexp_matches(text, '(?i)^\\s*select\\b') THEN 'Only SELECT queries are allowed' END",
        "CASE WHEN regexp_matches(text, ';\\s*\\S') THEN 'Multiple statements not allowed' END",
        "CASE WHEN NOT regexp_matches(text, '(?i)\\b(" + "|".join(X.COST_TABLES) + ")\\b') THEN 'Query must reference one of: "
        + ", ".join(X.COST_TABLES) + "' END",
    ]
    return "concat_ws('; ', " + ", ".join(parts) + ")"


@query("sql_checks", f"SELECT conv_id, turn, {_sql_checks()} AS errors FROM conversations")
def sql_checks(spark, sf):
    """The rules each logged text breaks as a SQL query."""
    errors = F.array_join(X.sql_errors(F.col("text")), "; ")
    return table(spark, sf, "conversations").select("conv_id", "turn", errors.alias("errors"))


@query(
    "clean_sql",
    r"""SELECT conv_id, turn, md5(regexp_replace(trim(regexp_replace(regexp_replace(text, '```(sql)?\n?', '', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')), '[; \t\n]+$', '') || ';') AS cleaned FROM conversations""",
)
def clean_sql(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", F.md5(X.clean_sql(F.col("text"))).alias("cleaned"))


@query(
    "attempt_confidence",
    """WITH a AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'),
    f AS (SELECT conv_id, COUNT(DISTINCT text) AS distinct_answers, arg_min(text, turn) AS sql FROM a GROUP BY 1),
    c AS (SELECT *, least((1.0::DOUBLE - (distinct_answers - 1) * 0.3::DOUBLE)
    * CASE WHEN (length(sql) - length(replace(sql, 'JOIN', ''))) / 4 > 2 THEN 0.9::DOUBLE ELSE 1.0 END
    * CASE WHEN regexp_matches(sql, '(?s)\\(.*SELECT') THEN 0.85::DOUBLE ELSE 1.0 END
    * CASE WHEN regexp_matches(upper(sql), 'SUM|COUNT|AVG') THEN 1.1::DOUBLE ELSE 1.0 END, 1.0) AS confidence FROM f)
    SELECT conv_id, distinct_answers, ROUND(confidence, 6) AS confidence, CASE WHEN confidence >= 0.9 THEN 'high' WHEN confidence >= 0.7 THEN 'medium' ELSE 'low' END AS band FROM c""",
)
def attempt_confidence(spark, sf):
    """A conversation's answers taken as attempts at one question."""
    attempts = table(spark, sf, "conversations").filter("role = 'assistant'")
    out = R.attempt_confidence(attempts, "conv_id", "turn", "text")
    return out.select("conv_id", "distinct_answers", F.round("confidence", 6).alias("confidence"), "band")


@query(
    "answer_bands",
    """SELECT CASE WHEN p >= 95 THEN 'high' WHEN p >= 70 THEN 'medium' ELSE 'low' END AS band, COUNT(*) AS n FROM
    (SELECT CAST(COUNT(*) FILTER (WHERE value > 5) AS DOUBLE) * 100 / COUNT(*) AS p FROM events GROUP BY user_id) GROUP BY 1""",
)
def answer_bands(spark, sf):
    """Users by the percentage of their events above a level."""
    per = table(spark, sf, "events").groupBy("user_id").agg(
        (F.count_if(F.col("value") > 5).cast("double") * 100 / F.count("*")).alias("p")
    )
    return per.groupBy(X.answer_band(F.col("p")).alias("band")).agg(F.count("*").alias("n"))


def _guess(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("n_chars") >= 300, 1).otherwise(0).alias("quality")
    )


@query(
    "label_accuracy",
    """WITH b AS (SELECT quality = (CASE WHEN n_chars >= 300 THEN 1 ELSE 0 END) AS ok FROM labels JOIN documents USING (doc_id))
    SELECT COUNT(*) AS cases, COUNT(*) FILTER (WHERE ok) AS correct, COUNT(*) FILTER (WHERE NOT ok) AS failed,
    CAST(COUNT(*) FILTER (WHERE ok) AS DOUBLE) / COUNT(*) AS accuracy FROM b""",
)
def label_accuracy(spark, sf):
    """A guess by length against the labelled set."""
    return R.accuracy(_guess(spark, sf), table(spark, sf, "labels"), "doc_id", "quality")


@query(
    "label_failures",
    """SELECT doc_id, CAST(quality AS BIGINT) AS want, CAST(CASE WHEN n_chars >= 300 THEN 1 ELSE 0 END AS BIGINT) AS got FROM labels JOIN documents USING (doc_id)
    WHERE quality <> (CASE WHEN n_chars >= 300 THEN 1 ELSE 0 END)""",
)
def label_failures(spark, sf):
    return R.failures(_guess(spark, sf), table(spark, sf, "labels"), "doc_id", "quality")


@query(
    "cache_hits",
    """WITH k AS (SELECT md5(lower(trim(text))) AS k, COUNT(*) AS n FROM documents GROUP BY 1)
    SELECT CAST(SUM(n) AS BIGINT) AS requests, CAST(SUM(n - 1) AS BIGINT) AS hits, COUNT(*) AS misses, CAST(SUM(n - 1) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) AS hit_rate FROM k""",
)
def cache_hits(spark, sf):
    """Document texts as a request log; a repeated key is a hit."""
    return R.cache_stats(table(spark, sf, "documents"), normal_key("text"))


@query(
    "follow_ups",
    r"""WITH p AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM conversations WHERE role = 'user')
    SELECT conv_id, turn, md5(previous) AS previous_md5 FROM p WHERE previous IS NOT NULL AND regexp_matches(text, '(?i)\b(that|it|same|also|too|what about|how about|and)\b')""",
)
def follow_ups(spark, sf):
    """Questions that refer back, with the one before them."""
    asked = table(spark, sf, "conversations").filter("role = 'user'")
    out = R.follow_ups(asked, "conv_id", "turn", "text")
    return out.select("conv_id", "turn", F.md5("previous_text").alias("previous_md5"))


@query(
    "multi_step",
    "SELECT conv_id, turn, " + _like_any(X.MULTI_STEP_PHRASES) + " AS multi_step, CASE "
    + " ".join(f"WHEN {_like_any(ws)} THEN '{c}'" for c, ws in X.QUESTION_CLASSES.items())
    + " ELSE 'other' END AS class FROM conversations WHERE role = 'user'",
)
def multi_step(spark, sf):
    asked = table(spark, sf, "conversations").filter("role = 'user'")
    return asked.select(
        "conv_id", "turn",
        X.contains_any(F.col("text"), X.MULTI_STEP_PHRASES).alias("multi_step"),
        X.question_class(F.col("text")).alias("class"),
    )


@query(
    "approved_examples",
    """SELECT md5('Q: ' || lang || ' | SQL: ' || text) AS doc_id, 'examples' AS category FROM documents JOIN labels USING (doc_id) WHERE quality = 1""",
)
def approved_examples(spark, sf):
    """Labelled documents as feedback: the good ones become examples."""
    feedback = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        F.col("lang").alias("question"), F.col("text").alias("sql"), (F.col("quality") == 1).alias("correct")
    )
    return R.approved_examples(feedback).select("doc_id", "category")


@query(
    "question_screen",
    "SELECT conv_id, turn, length(text) >= 3 AND length(text) <= 500 AND NOT "
    + _like_any([t.lower() for t in X.SCREENED_TOKENS])
    + " AS ok FROM conversations WHERE role = 'user'",
)
def question_screen(spark, sf):
    asked = table(spark, sf, "conversations").filter("role = 'user'")
    return asked.select("conv_id", "turn", X.question_ok(F.col("text")).alias("ok"))


@query(
    "wrapped_filters",
    r"""SELECT COUNT(*) FILTER (WHERE regexp_matches(q, '(?is)\bwhere\b.*\b\w+\s*\(\s*ts\b')) AS wrapped, COUNT(*) AS queries
    FROM (SELECT 'SELECT * FROM t WHERE ' || CASE WHEN event_type = 'view' THEN 'month(ts) = 3' ELSE 'ts >= ' || value END AS q FROM events)""",
)
def wrapped_filters(spark, sf):
    """A query log in which some filters wrap the time column."""
    sql = F.concat(
        F.lit("SELECT * FROM t WHERE "),
        F.when(F.col("event_type") == "view", "month(ts) = 3").otherwise(F.concat(F.lit("ts >= "), F.col("value"))),
    )
    return table(spark, sf, "events").agg(
        F.count_if(X.wraps_column(sql, "ts")).alias("wrapped"), F.count("*").alias("queries")
    )
