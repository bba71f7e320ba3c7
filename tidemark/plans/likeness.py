"""Likeness: vector cells, typos, token sets, probabilistic record linkage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import cells as C
from tidemark.operators import dedup as D
from tidemark.operators import linkage as L
from tidemark.operators import retrieval as R
from tidemark.operators import similarity as S
from tidemark.plans.questions import CENTROIDS, DIMS, HYBRID, TOP, _questions
from tidemark.plans.registry import query, table
from tidemark.session import cut


def _index(spark, sf):
    return C.build_cells(table(spark, sf, "embeddings"), "vec_id", "embedding", DIMS, category="label")


@query(
    "vector_cells_topk",
    f"WITH {CENTROIDS}, {TOP.format(where='')} SELECT question_id, vec_id, ROUND(sim, 4) AS similarity, rank FROM t WHERE rank <= 10",
)
def vector_cells_topk(spark, sf):
    """The ten most similar vectors through an inverted file, with its exact second pass."""
    hits = C.search_cells(_index(spark, sf), _questions(spark, sf), 10, exact=True)
    return hits.withColumn("similarity", F.round("similarity", 4))


@query(
    "vector_cells_label",
    f"WITH {CENTROIDS}, {TOP.format(where='WHERE e.label = q.label')} SELECT question_id, vec_id, ROUND(sim, 4) AS similarity, rank FROM t WHERE rank <= 5",
)
def vector_cells_label(spark, sf):
    hits = C.search_cells(_index(spark, sf), _questions(spark, sf), 5, category="label", exact=True)
    return hits.withColumn("similarity", F.round("similarity", 4))


@query("vector_cells_hybrid", f"WITH {HYBRID} SELECT question_id, vec_id, position FROM h WHERE position <= 5")
def vector_cells_hybrid(spark, sf):
    """Semantic hits, then category hits, both through the inverted file."""
    index, asked = _index(spark, sf), cut(_questions(spark, sf))
    parts = [C.search_cells(index, asked, 10, category=c, exact=True) for c in (None, "label")]
    return R.hybrid(*[p.select("question_id", "vec_id", "rank") for p in parts], "question_id", "vec_id", 5)


HOST = "regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1)"
HOSTS = f"h AS (SELECT {HOST} AS host, MIN(page_id) AS id, COUNT(*) AS pages FROM pages WHERE url IS NOT NULL GROUP BY 1)"


def _hosts(spark, sf):
    pages = table(spark, sf, "pages").filter("url IS NOT NULL")
    return pages.select("page_id", F.regexp_extract(F.lower("url"), r"^[a-z]+://([^/?#]*)", 1).alias("host"))


@query(
    "similar_hosts",
    f"""WITH {HOSTS} SELECT least(a.id, b.id) AS "left", greatest(a.id, b.id) AS "right", levenshtein(a.host, b.host) AS edits
    FROM h a JOIN h b ON a.id < b.id AND levenshtein(a.host, b.host) <= 2""",
)
def similar_hosts(spark, sf):
    """Hosts at most two edits apart, as pairs of the first pages of each host."""
    return S.similar_texts(_hosts(spark, sf), "page_id", F.col("host"), most_edits=2)[0]


@query(
    "similar_host_pages",
    f"""WITH {HOSTS} SELECT page_id, id AS representative, pages AS copies FROM pages JOIN h ON {HOST} = host WHERE url IS NOT NULL""",
)
def similar_host_pages(spark, sf):
    """Every page with the page that stands for its host."""
    return S.similar_texts(_hosts(spark, sf), "page_id", F.col("host"), most_edits=2)[1]


TURN_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


@query(
    "similar_turns",
    f"""WITH w AS (SELECT conv_id * 1000 + turn AS id, list_sort(list_distinct({TURN_WORDS})) AS words FROM conversations WHERE text IS NOT NULL),
    c AS (SELECT words, MIN(id) AS id FROM w WHERE len(words) > 0 GROUP BY 1), u AS (SELECT id, unnest(words) AS word FROM c),
    n AS (SELECT id, len(words) AS n FROM c),
    s AS (SELECT a.id AS l, b.id AS r, COUNT(*) AS k FROM u a JOIN u b ON a.word = b.word AND a.id < b.id GROUP BY 1, 2)
    SELECT l AS "left", r AS "right", ROUND(k / (x.n + y.n - k), 6) AS similarity FROM s JOIN n x ON l = x.id JOIN n y ON r = y.id
    WHERE k / (x.n + y.n - k) >= 0.2""",
)
def similar_turns(spark, sf):
    """Turns that share at least a fifth of their distinct words."""
    turns = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    links, _ = S.similar_sets(turns, "id", words, 0.2)
    return links.select("left", "right", F.round("similarity", 6).alias("similarity"))


def _rules():
    """Two customers are compared if they share a nation and a balance class, or a name ending."""
    ending = F.substring("c_name", -5, 5)
    return [
        L.MatchRule("name", F.col("c_name"), L.edit_similarity, (0.8, 0.9, 1.0), blocking=ending),
        L.MatchRule("segment", F.col("c_mktsegment"), L.equal),
        L.MatchRule(
            "balance", F.col("c_acctbal"), L.closeness(100.0), (0.5, 0.9),
            blocking=F.concat_ws("|", "c_nationkey", F.floor(F.col("c_acctbal") / 500).cast("string")),
        ),
    ]


LEVELS = """CAST(CASE WHEN e >= 1.0 - 1e-9 THEN 3 WHEN e >= 0.9 - 1e-9 THEN 2 WHEN e >= 0.8 - 1e-9 THEN 1 ELSE 0 END AS BIGINT) AS level_name,
    CAST(same AS BIGINT) AS level_segment, CAST(CASE WHEN near >= 0.9 - 1e-9 THEN 2 WHEN near >= 0.5 - 1e-9 THEN 1 ELSE 0 END AS BIGINT) AS level_balance"""


@query(
    "linkage_patterns",
    f"""WITH p AS (SELECT 1 - levenshtein(a.c_name, b.c_name) / greatest(length(a.c_name), length(b.c_name)) AS e, a.c_mktsegment = b.c_mktsegment AS same,
    greatest(0, 1 - abs(a.c_acctbal - b.c_acctbal) / 100) AS near FROM customer a JOIN customer b ON a.c_custkey < b.c_custkey
    AND ((a.c_nationkey = b.c_nationkey AND floor(a.c_acctbal / 500) = floor(b.c_acctbal / 500)) OR right(a.c_name, 5) = right(b.c_name, 5))),
    l AS (SELECT {LEVELS} FROM p) SELECT level_name, level_segment, level_balance, COUNT(*) AS pairs FROM l GROUP BY 1, 2, 3""",
)
def linkage_patterns(spark, sf):
    """How many candidate pairs agree how far in name, segment and balance."""
    pairs, _ = L.compared(table(spark, sf, "customer"), "c_custkey", _rules())
    return L.patterns(pairs, _rules())


@query("linkage_weights")
def linkage_weights(spark, sf):
    """The weight of each level of each rule, learnt from the patterns."""
    pairs, _ = L.compared(table(spark, sf, "customer"), "c_custkey", _rules())
    model = L.learn(L.patterns(pairs, _rules()), _rules())
    rows = [(r, k, float(w)) for r, ws in model.weights().items() for k, w in enumerate(ws)]
    return spark.createDataFrame(rows, "rule string, level int, weight double")


FIXED = {"name": (-4.0, 1.0, 3.0, 6.0), "segment": (-1.0, 2.0), "balance": (-3.0, 1.0, 4.0)}


@query(
    "linkage_links",
    f"""WITH p AS (SELECT a.c_custkey AS l, b.c_custkey AS r, 1 - levenshtein(a.c_name, b.c_name) / greatest(length(a.c_name), length(b.c_name)) AS e,
    a.c_mktsegment = b.c_mktsegment AS same, greatest(0, 1 - abs(a.c_acctbal - b.c_acctbal) / 100) AS near FROM customer a JOIN customer b ON a.c_custkey < b.c_custkey
    AND ((a.c_nationkey = b.c_nationkey AND floor(a.c_acctbal / 500) = floor(b.c_acctbal / 500)) OR right(a.c_name, 5) = right(b.c_name, 5))),
    v AS (SELECT l, r, {LEVELS} FROM p), w AS (SELECT l, r, [-4.0, 1.0, 3.0, 6.0][level_name + 1] + [-1.0, 2.0][level_segment + 1] + [-3.0, 1.0, 4.0][level_balance + 1] AS weight FROM v)
    SELECT l AS "left", r AS "right", CAST(weight AS DOUBLE) AS weight FROM w WHERE weight >= 7""",
)
def linkage_links(spark, sf):
    """Customers whose fixed weights for name, segment and balance reach 7."""
    rules = [L.MatchRule(r.name, r.value, r.score, r.levels, FIXED[r.name], r.blocking) for r in _rules()]
    links, _, _ = L.link_records(table(spark, sf, "customer"), "c_custkey", rules, threshold=7.0)
    return links.select("left", "right", "weight")


@query(
    "similar_host_groups",
    f"""WITH RECURSIVE {HOSTS}, e AS (SELECT a.id AS a, b.id AS b FROM h a JOIN h b ON a.id <> b.id AND levenshtein(a.host, b.host) <= 2),
    reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
    SELECT a AS node, least(a, MIN(b)) AS cluster FROM reach GROUP BY 1""",
)
def similar_host_groups(spark, sf):
    """Hosts chained by such pairs."""
    links, _ = S.similar_texts(_hosts(spark, sf), "page_id", F.col("host"), most_edits=2)
    return D.clusters(links, "left", "right")
