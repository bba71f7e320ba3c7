"""Deduplication: exact copies, record matching by rules, near copies, clusters."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut


def exact_copies(df: DataFrame, ident: str, columns: Sequence[str]) -> DataFrame:
    """Groups of rows equal in all ``columns``: fingerprint, survivor, copies."""
    print_ = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    return (
        df.select(ident, print_.alias("fingerprint"))
        .groupBy("fingerprint")
        .agg(F.min(ident).alias("survivor"), F.count("*").alias("copies"))
        .filter("copies > 1")
    )


def drop_exact_copies(df: DataFrame, ident: str, columns: Sequence[str]) -> DataFrame:
    """Keep the row with the smallest id of each set of exact copies."""
    print_ = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    kept = df.select(ident, print_.alias("_p")).groupBy("_p").agg(F.min(ident).alias(ident))
    return df.join(kept.select(ident), ident, "left_semi")


# --- record matching -------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Two records match on a rule when they share one of its signatures.

    ``signatures`` is a text or array-of-text column; NULL means no match.
    """

    name: str
    signatures: Column
    weight: float


def squeezed(text: Column) -> Column:
    """Lower case letters and digits only."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", "")


def one_edit(text: Column) -> Column:
    """The text with a blank card put in place of, or before or after, each character.

    The card stands for one character or none. Two texts share a form exactly when they
    are at most one edit apart, so no pairs have to be compared.
    """
    n = F.length(text)
    card = F.lit("\u0000")
    places = F.sequence(F.lit(0), n)
    put = F.transform(
        places, lambda i: F.concat(F.substring(text, F.lit(1), i), card, F.substring(text, i + 1, n))
    )
    swapped = F.transform(
        places, lambda i: F.concat(F.substring(text, F.lit(1), i), card, F.substring(text, i + 2, n))
    )
    # Past the last character nothing is swapped; that form equals the last put one.
    return F.when(text.isNotNull(), F.array_distinct(F.concat(put, swapped)))


def match_records(
    records: DataFrame, ident: str, rules: Sequence[Rule], threshold: float
) -> DataFrame:
    """Links (record, leader) between records whose matched weights reach ``threshold``.

    A pair reaches the threshold exactly when it agrees on some minimal set of rules,
    so each such set becomes one composite signature. Every record is linked to the
    smallest record sharing that signature: links grow with the records, not with
    the square of a block, and their connected components equal those of all pairs.
    """
    parts = []
    for chosen in _minimal_sets(rules, threshold):
        cols = [_as_array(records, r).alias(f"_s{i}") for i, r in enumerate(chosen)]
        keyed = records.select(F.col(ident).alias("record"), *cols)
        for i in range(len(chosen)):
            keyed = keyed.select("*", F.explode(f"_s{i}").alias(f"_t{i}")).drop(f"_s{i}")
        tag = "+".join(r.name for r in chosen)
        signature = F.sha2(F.to_json(F.struct(*[f"_t{i}" for i in range(len(chosen))])), 256)
        parts.append(keyed.select("record", F.lit(tag).alias("rules"), signature.alias("sig")))
    keys = parts[0]
    for p in parts[1:]:
        keys = keys.unionByName(p)
    leaders = keys.groupBy("rules", "sig").agg(
        F.min("record").alias("leader"), F.max("record").alias("_last")
    )
    leaders = leaders.filter("leader <> _last").drop("_last")
    return (
        keys.join(leaders, ["rules", "sig"])
        .filter("record <> leader")
        .select("record", "leader", "rules")
        .distinct()
    )


def _minimal_sets(rules: Sequence[Rule], threshold: float) -> list[tuple[Rule, ...]]:
    found: list[tuple[Rule, ...]] = []
    for size in range(1, len(rules) + 1):
        for chosen in combinations(rules, size):
            names = {r.name for r in chosen}
            if any({r.name for r in f} <= names for f in found):
                continue
            if sum(r.weight for r in chosen) >= threshold:
                found.append(chosen)
    if not found:
        raise ValueError("no set of rules reaches the threshold")
    return found


def _as_array(records: DataFrame, rule: Rule) -> Column:
    kind = records.select(rule.signatures.alias("s")).schema["s"].dataType.simpleString()
    if kind.startswith("array"):
        return rule.signatures
    return F.when(rule.signatures.isNotNull(), F.array(rule.signatures))


# --- near copies of long texts ------------------------------------------------------

_PRIME = np.uint64((1 << 31) - 1)


def shingles(text: Column, words: int = 3) -> Column:
    """Distinct hashes of all word n-grams of the whole text."""
    tokens = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def grams(tokens: Column) -> Column:
        n = F.size(tokens)
        # Shifted copies zipped together: linear in the text, unlike slicing per n-gram.
        shifted = [F.slice(tokens, F.lit(i + 1), F.greatest(n - i, F.lit(0))) for i in range(words)]
        rows = F.slice(F.arrays_zip(*[c.alias(f"w{i}") for i, c in enumerate(shifted)]), F.lit(1), F.greatest(n - words + 1, F.lit(1)))
        hashes = F.transform(rows, lambda r: F.xxhash64(r))
        return F.when(n > 0, F.array_distinct(hashes)).otherwise(F.array().cast("array<bigint>"))

    # As a lambda's argument the text is split once, not at each use of its words.
    return F.transform(F.array(tokens), grams)[0]


def spread(df: DataFrame) -> DataFrame:
    """Even out rows before heavy per-row work, over all cores at least."""
    spark = df.sparkSession
    parts = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    return df.repartition(parts)


def _minima(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, chunk: int = 1 << 15) -> Iterator[np.ndarray]:
    """For each set, the minima of (a * x + b) mod 2**31 - 1 for all a and b; sets are not empty.

    Small sets are taken together, large ones in parts, so that the work stays in the cache.
    """
    low = np.uint32(_PRIME)
    start = 0
    while start < len(sets):
        end, total = start + 1, len(sets[start])
        while end < len(sets) and total + len(sets[end]) <= chunk:
            total += len(sets[end])
            end += 1
        flat = np.concatenate([np.asarray(s, dtype=np.int64) for s in sets[start:end]]).view(np.uint64) % _PRIME
        sizes = np.array([len(s) for s in sets[start:end]])
        heads = np.cumsum(sizes) - sizes
        least = np.full((len(a), end - start), low)
        for at in range(0, len(flat), chunk):  # a second part exists for a single large set only
            x = flat[at : at + chunk]
            product, high, folded, less = np.empty_like(x), np.empty_like(x), np.empty(len(x), np.uint32), np.empty(len(x), np.uint32)
            for k in range(len(a)):
                np.multiply(x, a[k], out=product)
                product += b[k]
                # As 2**31 is 1 there, both halves add up to less than twice the prime.
                np.right_shift(product, np.uint64(31), out=high)
                product &= _PRIME
                np.add(product, high, out=folded, casting="unsafe")
                np.subtract(folded, low, out=less)
                np.minimum(folded, less, out=folded)
                np.minimum(least[k], np.minimum.reduceat(folded, heads), out=least[k])
        yield from least.T.astype(np.uint64)
        start = end


def band_keys(docs: DataFrame, ident: str, grams: str, bands: int, rows: int) -> DataFrame:
    """MinHash bands: one (band, bucket) row per document and band."""
    rng = np.random.default_rng(7)
    a = rng.integers(1, int(_PRIME), bands * rows, dtype=np.uint64)
    b = rng.integers(0, int(_PRIME), bands * rows, dtype=np.uint64)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch[grams].map(len) > 0]
            ids, band, bucket = [], [], []
            for key, low in zip(batch[ident], _minima(list(batch[grams]), a, b)):
                for i in range(bands):
                    ids.append(key)
                    band.append(i)
                    mark = hashlib.blake2b(low[i * rows : (i + 1) * rows].tobytes(), digest_size=8)
                    bucket.append(int.from_bytes(mark.digest(), "little", signed=True))
            yield pd.DataFrame({"doc": ids, "band": band, "bucket": bucket})

    kind = dict(docs.dtypes)[ident]
    return docs.select(ident, grams).mapInPandas(sign, f"doc {kind}, band int, bucket long")


def bands_for(threshold: float, rows: int, recall: float = 0.999) -> int:
    """Bands that a pair at the threshold needs to share one with this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def near_copies(
    docs: DataFrame,
    ident: str,
    text: str,
    threshold: float = 0.7,
    words: int = 3,
    bands: int | None = None,
    rows: int = 6,
    block: int = 128,
    block_grams: int = 1 << 21,
) -> DataFrame:
    """Links (doc, leader, similarity) between near copies, by verified Jaccard.

    Exact copies are folded first, and linked to their smallest document; texts without
    a word and NULL texts have no near copies. Two texts are candidates if they share a
    bucket; by default the bands give a pair at the threshold 0.999. The links connect the
    same documents as all candidate pairs at or above the threshold would, in two
    passes whatever the bucket: first every text with the smallest one of its bucket, then
    the texts unlike that one with the rest of the bucket, in blocks of bounded size.
    ``leader`` is the smaller document of a link.
    """
    bands = bands or bands_for(threshold, rows)
    folded = docs.filter(F.col(text).isNotNull()).groupBy(F.md5(text).alias("_f"))
    folded = folded.agg(F.min(ident).alias("doc"), F.first(text).alias("_t"))
    marked = cut(spread(folded).select("_f", "doc", shingles(F.col("_t"), words).alias("grams")))
    sets = marked.select("doc", "grams")
    keys = cut(band_keys(sets, "doc", "grams", bands, rows))
    sizes = keys.groupBy("band", "bucket").agg(F.min("doc").alias("leader"), F.count("*").alias("n"))
    members = cut(keys.join(sizes.filter("n > 1"), ["band", "bucket"]).filter("doc <> leader"))
    scored = cut(_with_leaders(members.select("doc", "leader").distinct(), sets, block))
    good = scored.filter(F.col("similarity") >= threshold)
    unlike = scored.filter(F.col("similarity") < threshold).select("doc", "leader")
    # Who is alone with the leader has been compared with the whole bucket.
    unlike = members.filter("n > 2").join(unlike, ["doc", "leader"], "left_semi")
    among = _block_links(members, cut(unlike), sets, threshold, block, block_grams)
    copies = (
        docs.select(F.col(ident).alias("doc"), F.md5(text).alias("_f"))
        .join(marked.select("_f", F.col("doc").alias("leader")), "_f")
        .filter("doc <> leader")
        .select("doc", "leader", F.lit(1.0).alias("similarity"))
    )
    return good.unionByName(among).distinct().unionByName(copies)


def _with_leaders(pairs: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Similarity of each (doc, leader). A leader of many is copied once per ``block`` docs."""
    parts = pairs.groupBy("leader").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int").alias("part")
    dealt = pairs.join(parts, "leader").select("doc", "leader", part)
    leaders = sets.join(parts.withColumnRenamed("leader", "doc"), "doc").select(
        F.col("doc").alias("leader"),
        F.col("grams").alias("other"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    )
    both = F.size(F.array_intersect("grams", "other"))
    total = F.size("grams") + F.size("other") - both
    met = dealt.join(sets, "doc").join(leaders, ["leader", "part"])
    return met.select("doc", "leader", (both / total).alias("similarity"))


def _block_links(
    members: DataFrame, unlike: DataFrame, sets: DataFrame, threshold: float, block: int, block_grams: int
) -> DataFrame:
    """Links of the unlike members of each bucket with its other members, but the leader.

    Both sides of a bucket are cut into blocks, and each pair of blocks is one group: it
    returns a spanning forest of its links, so at most one row per member.
    """
    held = members.join(unlike.select("band", "bucket").distinct(), ["band", "bucket"], "left_semi")
    sized = held.select("band", "bucket", "doc").join(sets.select("doc", F.size("grams").alias("g")), "doc")
    many = lambda name: F.greatest(
        F.ceil(F.count("*") / block), F.ceil(F.sum("g") / block_grams)
    ).cast("int").alias(name)
    bucket = ["band", "bucket"]
    all_blocks = sized.groupBy(*bucket).agg(many("js"))
    open_blocks = sized.join(unlike.select("doc", *bucket), ["doc", *bucket], "left_semi").groupBy(*bucket).agg(many("is"))
    blocks = cut(all_blocks.join(open_blocks, bucket))
    own = lambda n: F.pmod(F.xxhash64(F.lit(31), "doc"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asks = unlike.select(*bucket, "doc").join(blocks, bucket).select(*bucket, "doc", own("is").alias("i"), every("js").alias("j"), F.lit(True).alias("asks"))
    rest = held.select(*bucket, "doc").join(blocks, bucket).select(*bucket, "doc", every("is").alias("i"), own("js").alias("j"), F.lit(False).alias("asks"))
    tasks = asks.unionByName(rest).join(sets, "doc")

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["asks"]], rows[~rows["asks"]]
        found = []
        if len(left) and len(right):
            sizes = right["grams"].map(len).to_numpy()
            ids = right["doc"].to_numpy()
            values, place = np.unique(np.concatenate(right["grams"].to_list()), return_inverse=True)
            heads = np.cumsum(sizes) - sizes
            for doc, grams in zip(left["doc"], left["grams"]):
                held = np.zeros(len(values), bool)
                at = np.minimum(np.searchsorted(values, grams), len(values) - 1)
                held[at[values[at] == grams]] = True
                shared = np.add.reduceat(held[place], heads, dtype=np.int64)
                similarity = shared / (len(grams) + sizes - shared)
                near = (similarity >= threshold) & (ids != doc)
                found += zip(similarity[near], [doc] * int(near.sum()), ids[near])
        forest = [(max(a, b), min(a, b), s) for s, a, b in _forest(found)]
        return pd.DataFrame(forest, columns=["doc", "leader", "similarity"])

    kind = dict(sets.dtypes)["doc"]
    return tasks.groupBy(*bucket, "i", "j").applyInPandas(links, f"doc {kind}, leader {kind}, similarity double")


def _forest(links: list[tuple]) -> Iterator[tuple]:
    """The links (value, a, b) that connect what earlier ones have not."""
    up: dict = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for value, a, b in links:
        a_root, b_root = root(a), root(b)
        if a_root != b_root:
            up[a_root] = b_root
            yield value, a, b


def clusters(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of links: (node, cluster = smallest node).

    Minimum labels travel along the links and are shortcut through the label's own
    label, so long chains close in few rounds. Each round is checkpointed.
    """
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    edges = cut(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = cut(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("node")).alias("cluster")))
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("x"), "cluster"), "x")
            .groupBy(F.col("y").alias("node"))
            .agg(F.min("cluster").alias("_near"))
        )
        hop = labels.select(F.col("node").alias("cluster"), F.col("cluster").alias("_up"))
        step = (
            labels.join(near, "node")
            .join(hop, "cluster")
            .select(
                "node",
                F.col("cluster").alias("_old"),
                F.least("cluster", "_near", "_up").alias("cluster"),
            )
        )
        step = cut(step)
        labels = step.select("node", "cluster")
        if step.filter("cluster <> _old").isEmpty():
            return labels
