"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

Each window of an item is a set of short shingles. Shingles are ordered by rarity in the
whole corpus; a window that a document contains shares all of them, so the rarest one is a
necessary prefix and the only one joined. Position and length bounds drop pairs of which
the window would begin before the document or end behind it, the words decide the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import slices
from tidemark.llm.bytewords import filter_of, hashes, lower_az, shingles, spans, strings, text_bytes
from tidemark.session import cut

# Stands for a document word that is longer than every item word; no word has this character.
TOO_LONG = "-"


def _word_bytes() -> np.ndarray:
    """Bytes of words after lower-casing: 0-9, a-z and all of 0x80 and more."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x61:0x7B] = table[0x80:] = True
    return table


def _split(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the place of each word occurrence among them, and its text."""
    data, bounds = text_bytes(column)
    data = lower_az()[data]
    inside = _word_bytes()[data]
    starts, ends = spans(inside, bounds)
    coded = strings(data, inside, starts, ends).dictionary_encode()
    owner = np.searchsorted(bounds, starts, side="right") - 1
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), owner


def item_windows(items: DataFrame, key: str, text: str, window: int, shingle: int) -> DataFrame:
    """(item, words, n, longest, shingles) of each window: ``window`` consecutive words of an
    item, or all of one with fewer; ``shingles`` are in order, of ``shingle`` words or all.
    """
    source = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in slices(batches, 1):
            words, at, owner = _split(batch.column(1))
            names, of_word = words.to_pylist(), hashes(words)
            keys = batch.column(0).to_pylist()
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            rows: dict[str, list] = {"item": [], "words": [], "n": [], "longest": [], "shingles": []}
            for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                n = min(window, b - a)
                if not n:
                    continue
                size = min(shingle, n)
                mine = [names[w] for w in at[a:b]]
                found, _ = shingles(of_word[at[a:b]], np.zeros(b - a, np.int64), size)
                for p in range(b - a - n + 1):
                    rows["item"].append(keys[k])
                    rows["words"].append(" ".join(mine[p : p + n]))
                    rows["n"].append(n)
                    rows["longest"].append(max(map(len, mine[p : p + n])))
                    rows["shingles"].append(found[p : p + n - size + 1].view(np.int64))
            yield pa.RecordBatch.from_pydict(
                rows,
                pa.schema([("item", pa.string()), ("words", pa.string()), ("n", pa.int32()), ("longest", pa.int32()), ("shingles", pa.list_(pa.int64()))]),
            )

    return source.mapInArrow(run, "item string, words string, n int, longest int, shingles array<long>")


def _occurrences(texts: DataFrame, sizes: list[int], known) -> DataFrame:
    """(shingle, n): occurrences in the texts of the shingles that pass the filter."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in slices(batches, 0):
            words, at, owner = _split(batch.column(0))
            of_word = hashes(words)[at]
            for size in sizes:
                found, _ = shingles(of_word, owner, size)
                some, n = np.unique(found[shared.value.has(found)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), pa.array(n)], names=["shingle", "n"])

    return texts.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


def _candidates(docs: DataFrame, sizes: list[int], known, window: int, longest: int) -> DataFrame:
    """(key, n_words, near) of each document of (key, text): ``near`` has the places of
    shingles that pass the filter, with up to ``window`` words around each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)
    place = pa.struct([("shingle", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("around", pa.string())])

    def run(batches):
        for batch in slices(batches, 1):
            words, at, owner = _split(batch.column(1))
            of_word = hashes(words)[at]
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            where, what = [], []
            for size in sizes:
                found, place_of = shingles(of_word, owner, size)
                passed = shared.value.has(found)
                where.append(place_of[passed])
                what.append(found[passed])
            where, what = np.concatenate(where), np.concatenate(what)
            order = np.argsort(where, kind="stable")
            where, what = where[order], what[order]
            doc = owner[where]
            low = np.maximum(cuts[doc], where - window + 1)
            high = np.minimum(cuts[doc + 1], where + window)
            used = np.zeros(len(words), bool)
            for k in range(1 - window, window):
                near = np.clip(where + k, low, high - 1)
                used[at[near]] = True
            some = np.flatnonzero(used)
            names = dict(zip(some.tolist(), [w if len(w) <= longest else TOO_LONG for w in words.take(pa.array(some)).to_pylist()]))
            around = [" ".join([names[w] for w in at[a:b].tolist()]) for a, b in zip(low.tolist(), high.tolist())]
            rows = pa.StructArray.from_arrays(
                [pa.array(what.view(np.int64)), pa.array((where - cuts[doc]).astype(np.int32)), pa.array((where - low).astype(np.int32)), pa.array(around, pa.string())],
                fields=list(place),
            )
            offsets = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(cuts)), pa.ListArray.from_arrays(offsets, rows)], names=["key", "n_words", "near"]
            )

    schema = f"key {docs.schema['key'].dataType.simpleString()}, n_words long, near array<struct<shingle:long,at:int,before:int,around:string>>"
    return docs.mapInArrow(run, schema)


def find_windows(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = 10, shingle: int = 4
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All occurrences of item windows: (documents, hits, holders).

    ``documents`` has row (an id of this run, one per row of ``docs``), key and n_words;
    ``hits`` has row, start and n in words, and window, each occurrence once; ``holders`` has
    window and item for each item, as text (a null item key is the empty text).

    Words are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z
    lower-cased. Null and empty texts have no words, items without words no window. Equal
    windows of many items are joined once. The tables may have any other columns.
    """
    found = cut(item_windows(items, item_key, item_text, window, shingle))
    holders = found.select("words", "item").distinct()
    windows = found.groupBy("words").agg(F.first("n").alias("n"), F.max("longest").alias("longest"), F.first("shingles").alias("shingles"))
    windows = cut(windows.withColumn("window", F.monotonically_increasing_id()))
    longest = windows.agg(F.max("longest")).first()[0] or 0
    sizes = sorted({min(shingle, r[0]) for r in windows.select("n").distinct().collect()}) or [shingle]
    placed = windows.select("window", F.posexplode("shingles").alias("offset", "shingle"))
    known = cut(placed.select("shingle").distinct())
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    counts = _occurrences(source.select("text"), sizes, filter_of(known, "shingle"))
    # A shingle that the corpus lacks is the rarest of all: its windows then join nothing.
    rarity = placed.join(known.join(counts, "shingle", "left"), "shingle").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = rarity.groupBy("window").agg(F.min(F.struct("n", "offset", "shingle")).alias("best"))
    prefix = cut(rarest.filter("best.n > 0").select("window", "best.offset", "best.shingle").join(windows.select("window", "words", "n"), "window"))
    marked = _candidates(source, sizes, filter_of(prefix.select("shingle").distinct(), "shingle"), window, longest)
    marked = cut(marked.withColumn("row", F.monotonically_increasing_id()))
    near = marked.select("row", F.explode("near").alias("p")).select("row", "p.*")
    begins = F.col("before") - F.col("offset")
    pairs = near.join(prefix, "shingle").withColumn("around", F.split("around", " ", -1))
    bounded = pairs.filter((begins >= 0) & (begins + F.col("n") <= F.size("around")))
    exact = bounded.filter(F.array_join(F.slice("around", begins + 1, F.col("n")), " ") == F.col("words"))
    hits = cut(exact.select("row", (F.col("at") - F.col("offset")).alias("start"), "n", "window"))
    named = holders.join(windows.select("words", "window"), "words").select("window", "item")
    return marked.select("row", "key", "n_words"), hits, cut(named)


def judge(docs: DataFrame, items: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """One row per document: key, n_words, n_hit (words inside any occurrence of an item
    window), n_items (items with occurring windows), items (their keys, sorted as texts).

    See find_windows for ``how`` and for what counts as a word. Repeated rows of documents
    are rows of the result; rows of items with one key are one item.
    """
    documents, hits, holders = find_windows(docs, items, key, **how)
    ends = hits.select("row", "start", (F.col("start") + F.col("n")).alias("end")).distinct()
    earlier = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(earlier), F.lit(0))))
    covered = ends.withColumn("fresh", fresh).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    holding = hits.select("row", "window").distinct().join(holders, "window").select("row", "item").distinct()
    listed = holding.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    out = documents.join(covered.join(listed, "row"), "row", "left")
    none = F.array().cast("array<string>")
    return out.select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
    )
