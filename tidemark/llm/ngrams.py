"""N-gram Jaccard join: MinHash banding for candidates, full n-gram sets for the links."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import slices
from tidemark.llm.bytewords import Filter, filter_of
from tidemark.llm.links import block_pairs, components, linked_blocks
from tidemark.llm.words import DIGIT, LETTER, MARK, codepoints, distinct_words, mix, pieces, runs, simple_lower, unicode_classes, word_keys
from tidemark.session import cut

_U = np.uint64


def bands_for(threshold: float, rows: int, recall: float) -> int:
    """Bands of ``rows`` hashes so that a pair at the threshold shares one with this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def gram_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct word n-grams.

    Words are runs of letters, marks and digits in lower case. A text with fewer words has
    one gram, all its words; one without a word has none.
    """
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for parts, owner in pieces(texts):
        codes, bounds = codepoints(parts)
        if not len(codes):
            continue
        kinds = unicode_classes()[codes]
        inside = (kinds == LETTER) | (kinds == DIGIT) | (kinds == MARK)
        starts = np.flatnonzero(runs(inside, bounds))
        ends = np.append(starts[1:], len(codes))
        chosen = inside[starts]
        starts, ends = starts[chosen], ends[chosen]
        which, words = distinct_words(simple_lower()[codes], starts, ends)
        hashes = word_keys(words)[which]
        cuts = np.searchsorted(starts, bounds).tolist()
        for k, a, b in zip(owner, cuts[:-1], cuts[1:]):
            if b > a:
                found[k].append(hashes[a:b])
    out = []
    for some in found:
        words = np.concatenate(some) if some else np.empty(0, _U)
        size = min(n, len(words))
        if not size:
            out.append(np.empty(0, _U))
            continue
        grams = np.full(len(words) - size + 1, size, _U)
        for k in range(size):
            grams *= _U(0x9E3779B97F4A7C15)
            grams += words[k : len(words) - size + 1 + k]
        out.append(np.unique(mix(grams)))
    return out


def signatures(sets: list[np.ndarray], bands: int, rows: int, seed: int = 3, chunk: int = 1 << 16) -> np.ndarray:
    """One 64-bit key of each band for each set; sets must not be empty."""
    rng = np.random.default_rng(seed)
    many = bands * rows
    multiply = rng.integers(0, 1 << 32, many, np.uint32) | np.uint32(1)
    add = rng.integers(0, 1 << 32, many, np.uint32)
    sizes = np.array([len(s) for s in sets])
    least = np.full((many, len(sets)), np.uint32(0xFFFFFFFF))
    flat = (np.concatenate(sets) >> _U(32)).astype(np.uint32)
    heads = np.cumsum(sizes) - sizes
    a = 0
    while a < len(sets):  # groups of sets that stay in the cache; a large set is one group
        b = max(a + 1, int(np.searchsorted(heads + sizes, heads[a] + chunk, side="right")))
        x = flat[heads[a] : heads[b - 1] + sizes[b - 1]]
        at = heads[a:b] - heads[a]
        work = np.empty_like(x)
        for k in range(many):
            np.multiply(x, multiply[k], out=work)
            work += add[k]
            least[k, a:b] = np.minimum.reduceat(work, at)
        a = b
    keys = np.empty((len(sets), bands), _U)
    for band in range(bands):
        h = np.full(len(sets), band + 1, _U)
        for k in range(band * rows, band * rows + rows):
            h = mix(h * _U(0x9E3779B97F4A7C15) + least[k].astype(_U))
        keys[:, band] = h
    return keys


def fingerprints(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(key, uid, digest, grams, bands) from (key, uid, text): ``digest`` tells gram sets
    apart, ``grams`` is their size, ``bands`` the band keys; null for a text without a word.
    """

    def run(batches):
        for batch in slices(batches, 2):
            texts = [t or "" for t in batch.column(2).to_pylist()]
            digests: list[bytes | None] = []
            sizes: list[int] = []
            keys: list[np.ndarray | None] = []
            for a, b in _spans(texts):
                sets = gram_sets(texts[a:b], n)
                full = [s for s in sets if len(s)]
                signed = iter(signatures(full, bands, rows).astype(np.int64) if full else [])
                for s in sets:
                    digests.append(_digest(s) if len(s) else None)
                    sizes.append(len(s))
                    keys.append(next(signed) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64()))],
                names=["key", "uid", "digest", "grams", "bands"],
            )

    return docs.mapInArrow(run, "key long, uid binary, digest binary, grams int, bands array<long>")


def _digest(grams: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _spans(texts: list[str], most: int = 1_000_000):
    a, total = 0, 0
    for b, t in enumerate(texts, 1):
        total += len(t)
        if total >= most or b == len(texts):
            yield a, b
            a, total = b, 0


def with_sets(docs: DataFrame, n: int, wanted: Filter | None = None) -> DataFrame:
    """(uid, set) from (uid, text): the gram set as 64-bit numbers. ``wanted`` leaves out
    most rows whose uid it does not have, where they are read."""

    def run(batches):
        for batch in slices(batches, 1):
            if wanted is not None:
                batch = batch.filter(pa.array(wanted.has(batch.column(2).to_numpy())))
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sets = [s.tobytes() for a, b in _spans(texts) for s in gram_sets(texts[a:b], n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["uid", "set"])

    hashed = docs.select("uid", "text", F.xxhash64("uid").alias("hash"))
    return hashed.mapInArrow(run, "uid binary, set binary")


def sets_of(docs: DataFrame, needed: DataFrame, n: int) -> DataFrame:
    """The rows of ``needed`` (uid, ...) with the gram ``set`` of their text in ``docs`` (uid, text).

    Texts are not shuffled, whatever their number: a bounded filter of the needed uids finds
    them where they are read, and only their sets meet ``needed``.
    """
    wanted = filter_of(needed.select(F.xxhash64("uid").alias("hash")), "hash")
    return needed.join(with_sets(docs, n, wanted).dropDuplicates(["uid"]), "uid")


def jaccard_links(threshold: float, columns: int = 1 << 12):
    """Links of two blocks by the exact Jaccard similarity of their gram sets.

    Only members that share a band are linked. In a task of one band's bucket (``tab``) a
    pair counts if that is the first band that it shares, so it counts once.
    """

    def similar(left: dict, right: dict, same: bool) -> np.ndarray:
        one = [np.frombuffer(s, _U) for s in left["set"]]
        two = one if same else [np.frombuffer(s, _U) for s in right["set"]]
        a, b = np.array([len(s) for s in one]), np.array([len(s) for s in two])
        both = np.concatenate(one if same else one + two)
        grams, column = np.unique(both, return_inverse=True)
        owner = np.repeat(np.arange(len(one) + (0 if same else len(two))), a if same else np.append(a, b))
        # Only grams of at least two sets, and of both sides, can be shared.
        left_rows = owner < len(one)
        used = np.bincount(column[left_rows], minlength=len(grams))
        shared = used > 1 if same else (used > 0) & (np.bincount(column[~left_rows], minlength=len(grams)) > 0)
        place = np.cumsum(shared) - 1
        keep = shared[column]
        owner, column = owner[keep], place[column[keep]]
        common = np.zeros((len(one), len(two)), np.float32)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for start in range(0, int(shared.sum()), columns):
            lo, hi = np.searchsorted(column, [start, start + columns])
            o, c = owner[lo:hi], column[lo:hi] - start
            mine = o < len(one)
            x = np.zeros((len(one), columns), np.float32)
            x[o[mine], c[mine]] = 1
            if same:
                common += x @ x.T
            else:
                y = np.zeros((len(two), columns), np.float32)
                y[o[~mine] - len(one), c[~mine]] = 1
                common += x @ y.T
        return common.astype(np.float64) >= threshold * (a[:, None] + b[None, :] - common.astype(np.float64)) - 1e-9

    def verify(left: dict, right: dict, same: bool) -> np.ndarray:
        linked = similar(left, right, same)
        tab = left["tab"][0]
        bands_a = np.array(left["bands"], np.int64)
        bands_b = bands_a if same else np.array(right["bands"], np.int64)
        one, two = np.nonzero(linked)
        for a in range(0, len(one), columns):
            i, j = one[a : a + columns], two[a : a + columns]
            shared = bands_a[i] == bands_b[j]
            linked[i, j] = shared.any(axis=1) & ((tab < 0) | (shared.argmax(axis=1) == tab))
        return linked

    return verify


def uid_of(key: str, text: str) -> Column:
    """A SHA-256 of key and text, with nulls told apart from empty texts."""
    kind = F.when(F.col(text).isNull(), "!").otherwise(":")
    whole = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), kind, F.coalesce(F.col(text), F.lit("")))
    return F.unhex(F.sha2(whole, 256))


def comparison_tasks(classes: DataFrame, block: int, block_grams: int) -> tuple[DataFrame, DataFrame]:
    """Task rows (grp, i, j, second, id, tab) in which all candidate pairs of ``classes``
    (id, grams, bands) meet, and the ids that have a candidate.

    Candidates are members of one bucket of a band. Buckets that chain together are one
    component; it is compared as a whole where that loads fewer sets than to compare each
    of its buckets (``tab``: the band; -1 for a whole component): near copies share many
    bands and meet once, chains of small buckets never meet as a whole. The work is thus at
    most that of the buckets. Either way has the same links, as they need a shared band.
    """
    members = classes.select("id", F.posexplode("bands").alias("tab", "bucket"))
    heads = cut(members.groupBy("tab", "bucket").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    shared = cut(members.join(heads, ["tab", "bucket"]))
    chained = components(shared.select(F.col("id").alias("a"), F.col("head").alias("b")))
    grouped = cut(chained.select(F.col("label").alias("part"), "id").join(classes.select("id", "grams"), "id"))
    blocks = F.greatest(F.ceil(F.col("n") / block), F.col("w"), F.lit(1))
    weigh = (F.count(F.lit(1)).alias("n"), F.ceil(F.sum("grams") / block_grams).alias("w"))
    bucketed = cut(shared.select("id", "tab", "bucket").join(grouped, "id"))
    buckets = cut(bucketed.groupBy("part", "tab", "bucket").agg(*weigh))
    whole = grouped.groupBy("part").agg(*weigh)
    apart = buckets.groupBy("part").agg(F.sum(F.col("n") * blocks).alias("apart"))
    ways = cut(whole.join(apart, "part").withColumn("whole", F.col("n") * blocks <= F.col("apart")))
    in_whole, in_buckets = ways.filter("whole").select("part"), ways.filter("NOT whole").select("part")
    one = F.struct("part", F.lit(-1).alias("tab"), F.lit(0).cast("long").alias("bucket")).alias("grp")
    each = F.struct("part", "tab", "bucket").alias("grp")
    rows = grouped.join(in_whole, "part", "left_semi").select(one, "id", F.lit(-1).alias("tab")).unionByName(
        bucketed.join(in_buckets, "part", "left_semi").select(each, "id", "tab")
    )
    sizes = ways.filter("whole").select(one, "n", "w").unionByName(buckets.join(in_buckets, "part", "left_semi").select(each, "n", "w"))
    return block_pairs(rows, sizes, block), grouped.select("id")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8, rows: int = 8, recall: float = 0.999, block: int = 512, block_grams: int = 1 << 21
) -> DataFrame:
    """One row per document: key, uid, class_id, n_links, kept.

    Documents are linked if the Jaccard similarity of their word n-gram sets is at least
    the threshold; a pair at the threshold becomes a candidate with at least the given
    probability, a closer one more surely. ``class_id`` is the smallest key that links lead
    to, ``n_links`` the number of other documents linked directly, ``kept`` is true for
    the documents with the class's own key, and for null keys in classes without another.
    Documents without a word link with nothing. Repeated rows count as documents; null
    keys come after all others. ``uid`` hashes key and text, to find documents again.

    Copies (equal gram sets) are combined to one representative before bands are dealt
    out. Members of a bucket of a band are compared on full gram sets, in blocks, pair of
    blocks by pair of blocks, so no pair is written and no candidate is left out; whether
    two documents are linked does not depend on others.
    """
    bands = bands_for(threshold, rows, recall)
    source = docs.select(F.col(key).cast("long").alias("key"), uid_of(key, text).alias("uid"), F.col(text).alias("text"))
    marked = cut(fingerprints(source, n, bands, rows))
    classes = cut(
        marked.filter(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("key").alias("least"),
            F.min("uid").alias("uid"),
            F.first("grams").alias("grams"),
            F.first("bands").alias("bands"),
        )
        .withColumn("id", F.monotonically_increasing_id())
    )
    tasks, candidates = comparison_tasks(classes.select("id", "grams", "bands"), block, block_grams)
    needed = cut(classes.select("id", "uid", "copies", "bands").join(candidates, "id", "left_semi"))
    sets = cut(sets_of(source, needed, n).select("id", "copies", "set", "bands"))
    found = cut(linked_blocks(tasks.join(sets, "id"), jaccard_links(threshold), ["set", "bands", "tab"]))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("label", "part")
    named = cut(classes.select("id", "digest", "copies", "least").join(links, "id", "left").join(labels, "id", "left"))
    least = named.filter("part IS NOT NULL").groupBy("part").agg(F.min("least").alias("of_part"))
    known = cut(
        named.join(least, "part", "left").select(
            F.col("digest").alias("d"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.when(F.col("part").isNull(), F.col("least")).otherwise(F.col("of_part")).alias("class_id"),
        )
    )
    out = marked.select("key", "uid", "digest").join(known, F.col("digest") == F.col("d"), "left")
    class_id = F.when(F.col("d").isNull(), F.col("key")).otherwise(F.col("class_id"))
    return out.select(
        F.col("key").alias(key),
        "uid",
        class_id.alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("key").eqNullSafe(class_id).alias("kept"),
    )


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents with one of each class: the smallest key's, a repeated row once.

    A key that several texts share keeps each text whose class has that smallest key; of a
    class with only null keys every different text stays. Columns may have any name.
    """
    kept = near_duplicates(docs, key, text, **how).filter("kept").select("uid").distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    chosen = docs.select(uid_of(key, text).alias("uid"), whole).join(cut(kept), "uid", "left_semi")
    return chosen.dropDuplicates(["uid"]).select("doc.*")
