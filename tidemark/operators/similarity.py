"""Similarity joins: texts within a few edits, and token sets alike beyond a threshold.

Rows become signs, of which two similar rows must share one: the rarest tokens of a set or
the rarest character pieces of a text (prefix filter). Rows that share a sign meet in an
equi-join; a sign of very many rows is cut into blocks, and each pair of blocks is a join
key of its own. A pair of rows is looked at once, under its smallest shared sign. Where so
many sets share signs that this saves nothing, all pairs of sets are counted, block by block.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import setpairs
from tidemark.session import cut, fresh_path

BLOCK_ROWS = 512
PAIR_ROWS = 1 << 15
PAIR_TOKENS = 1 << 22
#: Two rows that meet under a sign cost about as much as so many pairs counted in blocks.
MEETING_PAIRS = 100


def meeting(rows: DataFrame, ident: str, signs: str, block: int = BLOCK_ROWS) -> DataFrame:
    """Each pair of rows that share a sign, once: every column c as left_c and right_c.

    ``ident`` is unique and orders the pair (left_ident < right_ident); ``signs`` is an array
    column without repeats. The result is not materialised: filter it at once.
    """
    postings = rows.select(ident, F.explode(signs).alias("_sign"))
    counts = postings.groupBy("_sign").agg(F.count("*").alias("_n")).filter("_n > 1")
    blocks = counts.select("_sign", F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    dealt = postings.join(blocks, "_sign").withColumn(
        "_own", F.pmod(F.xxhash64(F.lit(17), ident), F.col("_blocks")).cast("int")
    )
    columns = rows.columns
    whole = dealt.join(rows, ident)

    def side(name: str, first: Column, second: Column) -> DataFrame:
        keys = whole.withColumn("_i", first).withColumn("_j", second)
        return keys.select("_sign", "_i", "_j", *[F.col(c).alias(f"{name}_{c}") for c in columns])

    own = F.col("_own")
    later = F.explode(F.sequence(own, F.col("_blocks") - 1))
    earlier = F.explode(F.sequence(F.lit(0), own))
    keys = ["_sign", "_i", "_j"]
    # Pairs are far more than rows: dealt by the size of the rows, few tasks would make them all.
    context = rows.sparkSession.sparkContext
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * context.defaultParallelism)
    left, right = side("left", own, later).repartition(parts, *keys), side("right", earlier, own).repartition(parts, *keys)
    met = left.hint("merge").join(right, keys)
    a, b = F.col(f"left_{ident}"), F.col(f"right_{ident}")
    # Within one block both orders meet, between two blocks only one.
    once = (a < b) | ((F.col("_i") < F.col("_j")) & (a > b))
    # The only sign of a row is the first shared one; otherwise the signs are compared.
    only = (F.size(f"left_{signs}") == 1) | (F.size(f"right_{signs}") == 1)
    first_shared = F.array_min(F.array_intersect(f"left_{signs}", f"right_{signs}")) == F.col("_sign")
    pairs = met.filter(once & (only | first_shared))
    swap = F.col(f"left_{ident}") > F.col(f"right_{ident}")
    out = []
    for c in columns:
        x, y = F.col(f"left_{c}"), F.col(f"right_{c}")
        out += [F.when(swap, y).otherwise(x).alias(f"left_{c}"), F.when(swap, x).otherwise(y).alias(f"right_{c}")]
    return pairs.select(*out)


def _rarest(rows: DataFrame, ident: str, tokens: str, keep: Column, name: str) -> DataFrame:
    """Adds ``name``: the ``keep`` rarest of each row's distinct tokens, rarity over all rows."""
    listed = rows.select(ident, F.explode(tokens).alias("_t"))
    counts = listed.groupBy("_t").agg(F.count("*").alias("_n"))
    ranked = (
        listed.join(counts, "_t")
        .groupBy(ident)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_t"))), lambda s: s["_t"]).alias("_ranked"))
    )
    return rows.join(ranked, ident, "left").withColumn(name, F.slice("_ranked", F.lit(1), keep)).drop("_ranked")


def similar_sets(
    rows: DataFrame, ident: str, tokens: Column, threshold: float, by_signs: bool | None = None
) -> tuple[DataFrame, DataFrame]:
    """(links, members) of rows whose token sets have a Jaccard similarity >= ``threshold``.

    Rows with one set are one class, named by its smallest ident. ``members`` has every row:
    ident, representative, copies (rows of the class). ``links`` has every pair of similar
    classes: left, right (representatives, left < right), similarity. Rows with a null or
    empty set, and null idents, are in neither. Order and repeats of tokens do not matter.

    Two sets that reach the threshold t share one of the size - ceil(t * size) + 1 rarest
    tokens of each, and their sizes differ by no more than a factor of t.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    sets = rows.select(F.col(ident).alias("ident"), F.array_sort(F.array_distinct(F.array_compact(tokens))).alias("set"))
    sets = cut(sets.filter(F.col("ident").isNotNull() & (F.size("set") > 0)))
    classes = sets.groupBy("set").agg(F.min("ident").alias("rep"), F.count("*").alias("copies"))
    classes = cut(classes.withColumn("n", F.size("set")))
    members = sets.join(classes.select("set", "rep", "copies"), "set").select(
        F.col("ident").alias(ident), F.col("rep").alias("representative"), "copies"
    )
    # A little slack keeps rounding from shortening a prefix; the verification is exact.
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(threshold - 1e-9)).cast("int") + 1
    signed = cut(_rarest(classes.select("rep", "set", "n"), "rep", "set", prefix.cast("int"), "signs").drop("set"))
    if by_signs is None:
        n = classes.count()
        by_signs = _meetings(signed, "signs") * MEETING_PAIRS <= n * (n - 1) // 2
    if not by_signs:
        return _counted_links(classes, threshold), members
    close = F.least("left_n", "right_n") >= F.greatest("left_n", "right_n") * F.lit(threshold - 1e-9)
    pairs = meeting(signed, "rep", "signs").filter(close).select("left_rep", "right_rep")
    of = lambda side: classes.select(F.col("rep").alias(f"{side}_rep"), F.col("set").alias(f"{side}_set"))
    both = pairs.join(of("left"), "left_rep").join(of("right"), "right_rep")
    shared = F.size(F.array_intersect("left_set", "right_set"))
    total = F.size("left_set") + F.size("right_set") - shared
    scored = both.select(F.col("left_rep").alias("left"), F.col("right_rep").alias("right"), (shared / total).alias("similarity"))
    return scored.filter(F.col("similarity") >= threshold), members


def _meetings(rows: DataFrame, signs: str) -> int:
    """How many times two rows meet under a sign."""
    counts = rows.select(F.explode(signs).alias("_sign")).groupBy("_sign").agg(F.count("*").alias("n"))
    return counts.agg(F.sum(F.expr("n * (n - 1) DIV 2"))).first()[0] or 0


def _counted_links(classes: DataFrame, threshold: float, block: int = PAIR_ROWS, block_tokens: int = PAIR_TOKENS) -> DataFrame:
    """Links of all pairs of sets, by the number of tokens that they share.

    Sets are dealt into blocks of about ``block`` rows and ``block_tokens`` tokens at most,
    each written once to the shared folder; a task reads the two blocks of a pair of blocks.
    So the disk that this takes grows with the sets, only the time with their pairs.
    """
    spark = classes.sparkSession
    # Two steps: in one, a set's hash would be worked out again for each of its tokens.
    named = classes.select("rep", F.xxhash64("set").alias("_of"), F.size("set").alias("size"), "set")
    listed = named.select("rep", "_of", "size", F.explode("set").alias("_t"))
    # A token of one set only is not shared.
    held = cut(listed.groupBy("_t").agg(F.count("*").alias("_n")).filter("_n > 1"))
    often = held.orderBy(F.desc("_n"), "_t").limit(setpairs.BITS)
    often = often.select("_t", (F.row_number().over(Window.orderBy(F.desc("_n"), "_t")) - 1).cast("long").alias("_bit"))
    rest = F.monotonically_increasing_id() + setpairs.BITS
    codes = cut(held.join(F.broadcast(often), "_t", "left").select("_t", F.coalesce("_bit", rest).alias("_code")))
    n, tokens = classes.count(), held.agg(F.sum("_n")).first()[0]
    # Enough blocks that their pairs occupy all cores, unless that leaves a block few rows.
    cores = spark.sparkContext.defaultParallelism
    blocks = max(1, min(math.ceil(2 * cores**0.5), math.ceil(n / 256)), math.ceil(n / block), math.ceil((tokens or 0) / block_tokens))
    coded = listed.join(codes, "_t").groupBy("rep", "_of", "size").agg(F.collect_list("_code").alias("codes"))
    own = F.pmod(F.xxhash64(F.lit(19), "rep"), F.lit(blocks)).cast("int")
    folder = fresh_path(spark, "blocks")
    coded.select("rep", "size", "codes", own.alias("block")).repartition(blocks, "block").write.partitionBy("block").parquet(folder)
    pairs = blocks * (blocks + 1) // 2
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 64 * cores)
    kind = classes.schema["rep"].dataType
    out = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("similarity", T.DoubleType())])
    found = spark.range(0, pairs, 1, min(pairs, tasks)).mapInArrow(setpairs.block_links(folder, blocks, threshold), out)
    links = found.select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"), "similarity")
    return links.filter("left < right")


def pieces_of(text: Column, q: int) -> Column:
    """All runs of ``q`` characters, the k-th equal one marked with k, so that they form a set."""
    n = F.length(text)
    all_ = F.transform(F.sequence(F.lit(1), n - q + 1), lambda i: F.substr(text, i, F.lit(q)))
    all_ = F.when(n >= q, all_).otherwise(F.array().cast("array<string>"))
    # Sorted, equal pieces are neighbours, and the k-th of them is k - 1 behind the first.
    ordered = F.array_sort(all_)
    return F.transform(ordered, lambda g, i: F.concat(g, F.lit("\u0001"), (i - F.array_position(ordered, g)).cast("string")))


def deletions(text: Column, most: int) -> Column:
    """The text and all that is left of it after up to ``most`` deleted characters."""

    def shorter(texts: Column) -> Column:
        def one(t: Column) -> Column:
            n = F.length(t)
            cuts = F.transform(
                F.sequence(F.lit(1), n), lambda i: F.concat(F.substr(t, F.lit(1), i - 1), F.substr(t, i + 1))
            )
            return F.when(n > 0, cuts).otherwise(F.array().cast("array<string>"))

        return F.array_distinct(F.flatten(F.transform(texts, one)))

    levels = [F.array(text)]
    for _ in range(most):
        levels.append(shorter(levels[-1]))
    return F.array_distinct(reduce(lambda a, b: F.concat(a, b), levels))


def similar_texts(rows: DataFrame, ident: str, text: Column, most_edits: int = 2, q: int = 2) -> tuple[DataFrame, DataFrame]:
    """(links, members) of texts that are at most ``most_edits`` edits apart.

    Equal texts are one class, named by its smallest ident: ``members`` has every row with a
    text (ident, representative, copies), ``links`` every pair of classes within the
    distance (left, right, left < right, and edits >= 1). Null texts and idents are in
    neither; an empty text is a text.

    An edit changes at most q character pieces, so two texts of q * (edits + 1) characters
    or more share one of the q * edits + 1 rarest pieces of each. Shorter texts, and those
    they may be close to, share what is left after deleting as many characters as edits.
    """
    if most_edits < 1 or q < 1:
        raise ValueError("at least one edit and one character")
    texts = rows.select(F.col(ident).alias("ident"), text.alias("text")).filter("ident IS NOT NULL AND text IS NOT NULL")
    classes = cut(texts.groupBy("text").agg(F.min("ident").alias("rep"), F.count("*").alias("copies")))
    members = texts.join(classes, "text").select(F.col("ident").alias(ident), F.col("rep").alias("representative"), "copies")
    least = q * (most_edits + 1)
    long = F.length("text") >= least
    sets = classes.select("rep", "text", F.when(long, pieces_of(F.col("text"), q)).alias("pieces"))
    ranked = _rarest(sets, "rep", "pieces", F.lit(q * most_edits + 1), "rare")
    none = F.array().cast("array<string>")
    tagged = lambda tag, c: F.transform(F.coalesce(c, none), lambda s: F.concat(F.lit(tag), s))
    short = F.when(F.length("text") < least + most_edits, deletions(F.col("text"), most_edits))
    signed = cut(ranked.select("rep", "text", F.concat(tagged("p", F.col("rare")), tagged("d", short)).alias("signs")))
    edits = F.levenshtein("left_text", "right_text", most_edits)
    near = F.abs(F.length("left_text") - F.length("right_text")) <= most_edits
    found = meeting(signed, "rep", "signs").filter(near).select("left_rep", "right_rep", edits.alias("edits"))
    return found.filter("edits >= 0").select(F.col("left_rep").alias("left"), F.col("right_rep").alias("right"), "edits"), members


def prefix_size(size: int, threshold: float) -> int:
    """How many of a set's rarest tokens must be looked at."""
    return size - math.ceil(size * threshold - 1e-9) + 1
