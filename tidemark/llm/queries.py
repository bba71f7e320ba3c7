"""The operators applied to the given tables, and their SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import align, ann, bpe, decontaminate, langid, mixing, ngrams, phrases, separators, tokenids, urlfilter, vectordups, warc

BYTE_BPE, END_OF_TEXT = "byte_bpe_50k.json", 50256
WORD_BPE, END_ID = "word_bpe_49k.json", 1
PIECE_BPE = "piece_bpe_32k.model"
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(key: Column) -> Column:
    """crc32 of the key as text, mod 5; a null key is an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: five words, similarity 0.8."""
    return ngrams.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "kept")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectordups.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op4_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    library = tokenids.load(public_tokenizers.path(WORD_BPE))
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = tokenids.encode(documents, library, END_ID, width=2).drop("text")
    back = tokenids.read_shards(tokenids.write_shards(encoded, width=2))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document, counted in flat files by their end ids."""
    vocab = bpe.load(public_tokenizers.path(BYTE_BPE))
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(documents, vocab, special=False).drop("text")
    written = separators.write_flat(encoded, END_OF_TEXT)
    counts = separators.count_tokens(written, END_OF_TEXT)
    return written.join(counts, ["path", "place"]).select("doc_id", "n_tokens")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "source", "size", "source_size", "target", "taken")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(warc.with_types(_table(spark, sf_dir, "pages")))
    return warc.read(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(documents.filter(fold(F.col("doc_id")) != 0))
    found = langid.identify(documents.drop("lang"), model)
    return found.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), lambda key: key % 20 == 0)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = bpe.load(public_tokenizers.path(BYTE_BPE))
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(documents, vocab).drop("text")
    decoded = bpe.decode(encoded, vocab)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return judged.select("doc_id", "n_words", "n_hit", "n_items", listed.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = bpe.load(public_tokenizers.path(BYTE_BPE))
    pieces = align.load_pieces(public_tokenizers.path(PIECE_BPE))
    return align.score(_table(spark, sf_dir, "documents"), vocab, pieces)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("grp", "lang")


QUERIES = {
    name: f for name, f in list(globals().items()) if name.startswith("op") and callable(f) and name[2].isdigit()
}

_HOST = "CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END"
_PATH = "CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END"

ORACLES = {
    "op3_url_filters": f"""
WITH p AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
r(rule_host, rule_path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
 ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
won AS (SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
 arg_max(verdict, length(rule_host || rule_path)) AS verdict
 FROM (SELECT DISTINCT host, path FROM p) AS u
 JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
 GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, COALESCE(verdict, 'allow') AS verdict
FROM p LEFT JOIN won ON p.host = won.host AND p.path = won.path""",
    "op7_warc": """
WITH p AS (SELECT page_id, octet_length(encode(COALESCE(html, ''))) AS payload_bytes,
 sha256(COALESCE(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest AS d, MIN(page_id) AS f FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
 CASE WHEN f IS NULL OR page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> f THEN f END AS refers_to
FROM p LEFT JOIN firsts ON payload_digest = d""",
    "op11_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
parts AS (SELECT item, w, LEAST(len(w), 10) AS n, UNNEST(range(1, len(w) - LEAST(len(w), 10) + 2)) AS p FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS phrase FROM parts),
places AS (SELECT doc_id, w, n, UNNEST(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM windows) AS sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, p, windows.n, item FROM places JOIN windows ON windows.n = places.n AND phrase = array_to_string(w[p:p + places.n - 1], ' ')),
hit_words AS (SELECT doc_id, COUNT(DISTINCT k) AS n_hit FROM (SELECT doc_id, UNNEST(range(p, p + n)) AS k FROM hits) AS u GROUP BY doc_id),
hit_items AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) AS u GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
 sha256(COALESCE(items, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
    "op13_collocations": r"""
WITH pieces AS (SELECT COALESCE(lang, 'und') AS lang, UNNEST(string_split_regex(
  translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
words AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, size, array_to_string(w[p:p + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, UNNEST(range(1, len(w) - size + 2)) AS p FROM words, (VALUES (1), (2), (3)) AS s(size) WHERE len(w) >= size) AS u),
f AS (SELECT lang, size, phrase, COUNT(*) AS f FROM grams GROUP BY 1, 2, 3),
totals AS (SELECT lang, CAST(SUM(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
found AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, size FROM f WHERE size > 1 AND f >= 10),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM (SELECT *, UNNEST(range(1, size)) AS k FROM found) AS u),
scored AS (SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r,
  (1000000 * CAST(a AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts AS c JOIN f AS x ON x.lang = c.lang AND x.phrase = lp JOIN f AS y ON y.lang = c.lang AND y.phrase = rp),
weakest AS (SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, phrase, MAX(a) AS most FROM (
  SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM found WHERE size = 3
  UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM found WHERE size = 3) AS u GROUP BY 1, 2),
kept AS (SELECT w.* FROM weakest AS w LEFT JOIN longer AS g ON g.lang = w.lang AND g.phrase = w.phrase WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000""",
}
