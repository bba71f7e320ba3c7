"""Phrase collocations: counts by multikey three-way quicksort of suffix pointers.

A suffix pointer is a word occurrence with the words behind it in its piece, to a maximum
depth. Pointers are combined where they are read, routed by group and leading word (all
words, where the leading word is very frequent), and each route is partitioned word by word
into less, equal and greater; the weight of an equal partition is the count of its phrase,
and partitions that weigh too little are abandoned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import slices
from tidemark.llm.bytewords import classes, filter_of, hashes, lower_az, spans, strings, text_bytes
from tidemark.llm.words import mix
from tidemark.session import cut

# What ends a piece, and what ends a word within a piece.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"
NO_GROUP = "und"
END = -1
BATCH_ROWS = 50_000
TASK_WORDS = 2_000_000


def equal_partitions(
    symbols: np.ndarray, weights: np.ndarray, least: int = 1, deepest: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey three-way quicksort of all rows of ``symbols`` (pointers x depth), by whole levels:
    (pointer, depth, weight) of each equal partition that weighs ``least`` or more, where the
    pointer is one of its members; with ``deepest`` only those of the full depth.

    Every round splits all unfinished partitions by the symbol of their middle pointer into
    less, equal and greater, at once. Equal ones are counted and go on one symbol deeper;
    partitions below ``least`` are abandoned, as nothing in them can reach it.
    """
    most = symbols.shape[1]
    flat = np.ascontiguousarray(symbols).reshape(-1)
    order = np.arange(len(symbols))
    weight = weights.astype(np.int64)
    heads = np.zeros(min(1, len(order)), np.int64)
    depth = np.zeros(len(heads), np.int64)
    out = [(np.empty(0, np.int64),) * 3]
    while len(order):
        sizes = np.diff(np.append(heads, len(order)))
        of = np.repeat(np.arange(len(heads)), sizes)
        at = flat[order * most + depth[of]]
        pivot = at[heads + sizes // 2][of]
        side = (at > pivot).astype(np.int8) + (at >= pivot)
        many = np.zeros((len(heads), 3), np.int64)
        for k in range(3):
            many[:, k] = np.add.reduceat(side == k, heads)
        begin = (np.cumsum(many.reshape(-1)) - many.reshape(-1)).reshape(-1, 3)
        place = np.empty(len(order), np.int64)
        for k in range(3):
            mine = np.flatnonzero(side == k)
            before = np.cumsum(many[:, k]) - many[:, k]
            place[mine] = np.arange(len(mine)) + (begin[:, k] - before)[of[mine]]
        moved, moved_weight = np.empty_like(order), np.empty_like(weight)
        moved[place], moved_weight[place] = order, weight
        new = np.flatnonzero(many)
        heads, sizes = begin.reshape(-1)[new], many.reshape(-1)[new]
        equal = new % 3 == 1
        depth = depth[new // 3] + equal
        total = np.add.reduceat(moved_weight, heads)
        if deepest:
            # A pointer alone is its own partition at every depth.
            depth[sizes == 1] = most
            equal |= sizes == 1
        counted = equal & (total >= least) & ((depth == most) | (not deepest))
        out.append((moved[heads[counted]], depth[counted], total[counted]))
        going = (total >= least) & (depth < most)
        keep = np.repeat(going, sizes)
        order, weight = moved[keep], moved_weight[keep]
        sizes, depth = sizes[going], depth[going]
        heads = np.cumsum(sizes) - sizes
    return tuple(np.concatenate(x) for x in zip(*out))


def _words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, the place of each occurrence among them, its text, and its piece."""
    data, bounds = text_bytes(column)
    data = lower_az()[data]
    breaks = classes(PIECE_ENDS)[data]
    inside = ~(breaks | classes(BLANKS)[data])
    starts, ends = spans(inside, bounds)
    coded = strings(data, inside, starts, ends).dictionary_encode()
    owner = np.searchsorted(bounds, starts, side="right") - 1
    piece = np.cumsum(breaks)[starts] if len(starts) else np.empty(0, np.int64)
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), owner, piece + owner


def _groups(column: pa.Array) -> tuple[list[str], np.ndarray]:
    codes, names = pd.factorize(np.array([g if g is not None else NO_GROUP for g in column.to_pylist()], object))
    return list(names), codes


def word_counts(docs: DataFrame, most_bytes: int = 2_000_000) -> DataFrame:
    """(grp, word, f) from (grp, text), combined where it is read."""

    def run(batches):
        for batch in slices(batches, 1, most_bytes):
            words, at, owner, _ = _words(batch.column(1))
            names, of = _groups(batch.column(0))
            key, n = np.unique(of[owner] * max(1, len(words)) + at, return_counts=True)
            g, w = np.divmod(key, max(1, len(words)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in g.tolist()], pa.string()), words.take(pa.array(w)).cast(pa.string()), pa.array(n)], names=["grp", "word", "f"]
            )

    return docs.mapInArrow(run, "grp string, word string, f long").groupBy("grp", "word").agg(F.sum("f").alias("f"))


def _key(groups: np.ndarray, words: np.ndarray) -> np.ndarray:
    """64-bit key of a word in a group; different words may share one, filters allow that."""
    return (groups * np.uint64(0x9E3779B97F4A7C15)) ^ words


def word_keys(words: DataFrame) -> DataFrame:
    """The keys of (grp, word) rows, as the readers of texts make them."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_key(hashes(batch.column(0)), hashes(batch.column(1))).view(np.int64))], names=["key"])

    return words.select("grp", "word").mapInArrow(run, "key long")


def suffixes(docs: DataFrame, frequent, hot, most_words: int, routes: int, most_bytes: int = 750_000) -> DataFrame:
    """(route, grp, phrase, n) from (grp, text): suffixes of two to ``most_words`` words, cut
    before the first infrequent word, each counted within a slice of the input.

    A route below ``routes`` takes all suffixes of its leading words. Where the leading word
    passes the ``hot`` filter, a route of ``routes`` or more takes all equal suffixes.
    """
    shared = docs.sparkSession.sparkContext.broadcast((frequent, hot))

    def run(batches):
        often, very = shared.value
        for batch in slices(batches, 1, most_bytes):
            words, at, owner, piece = _words(batch.column(1))
            names, of = _groups(batch.column(0))
            if len(at) < 2:
                continue
            of_word, of_group = hashes(words), hashes(pa.array(names, pa.string()))
            group = of[owner]
            codes, unique = pd.factorize(group * len(words) + at)
            keys = _key(of_group[unique // len(words)], of_word[unique % len(words)])
            known, split = often.has(keys)[codes], very.has(keys)[codes]
            symbols = np.full((len(at), 1 + most_words), END, np.int32)
            symbols[:, 0] = group
            here = known
            for k in range(min(most_words, len(at))):
                on = np.flatnonzero(here)
                symbols[on, 1 + k] = at[on + k]
                n = len(at) - k - 1
                here = np.append(here[:n] & known[k + 1 :] & (piece[k + 1 :] == piece[:n]), np.zeros(k + 1, bool))
            led = np.flatnonzero(symbols[:, 2] != END)
            if not len(led):
                continue
            member, _, counts = equal_partitions(symbols[led], np.ones(len(led), np.int64), deepest=True)
            member = led[member]
            chosen = symbols[member]
            route = _key(of_group[chosen[:, 0]], of_word[chosen[:, 1]])
            whole = route.copy()
            for k in range(2, 1 + most_words):
                whole = mix(whole * np.uint64(0xD6E8FEB86659FD93) + np.where(chosen[:, k] == END, np.uint64(1), of_word[chosen[:, k]]))
            very_many = split[member]
            route = np.where(very_many, whole, mix(route)) % np.uint64(routes) + np.uint64(routes) * very_many.astype(np.uint64)
            parts = [words.take(pa.array(np.maximum(chosen[:, k], 0), mask=chosen[:, k] == END)) for k in range(1, 1 + most_words)]
            phrases = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()), null_handling="skip")
            rows = pa.RecordBatch.from_arrays(
                [
                    pa.array(route.astype(np.int32)),
                    pa.DictionaryArray.from_arrays(pa.array(chosen[:, 0].astype(np.int32)), pa.array(names, pa.string())).cast(pa.string()),
                    phrases.cast(pa.string()),
                    pa.array(counts),
                ],
                names=["route", "grp", "phrase", "n"],
            )
            for start in range(0, rows.num_rows, BATCH_ROWS):
                yield rows.slice(start, BATCH_ROWS)

    return docs.mapInArrow(run, "route int, grp string, phrase string, n long")


def route_counts(rows: DataFrame, least: int, most_words: int, routes: int, parts: int, most_rows: int = 60_000) -> DataFrame:
    """(grp, phrase, f) of the phrases of two words and more in the routed suffixes.

    Routes are sorted by Spark, in ``parts`` tasks, and taken one after another, small ones together. Counts
    below ``least`` are abandoned; the shorter phrases of very frequent leading words lie in
    several routes, so theirs are added up first.
    """

    def counted(held: list, split: bool):
        table = pa.Table.from_batches(held).combine_chunks()
        group = table["grp"].combine_chunks().dictionary_encode()
        words = pc.split_pattern(table["phrase"].combine_chunks().cast(pa.large_string()), " ")
        flat = words.flatten().dictionary_encode()
        sizes = pc.list_value_length(words).to_numpy()
        symbols = np.full((len(sizes), 1 + most_words), END, np.int32)
        symbols[:, 0] = group.indices.to_numpy()
        inner = np.arange(1 + most_words)[None, 1:] <= sizes[:, None]
        symbols[:, 1:][inner] = flat.indices.to_numpy()
        member, depth, f = equal_partitions(symbols, table["n"].to_numpy(), 1 if split else least)
        chosen = (depth >= 3) & (symbols[member, depth - 1] != END) & ((f >= least) | (depth <= most_words))
        member, depth, f = member[chosen], depth[chosen], f[chosen]
        parts = []
        for k in range(1, 1 + most_words):
            code = symbols[member, k]
            parts.append(flat.dictionary.take(pa.array(np.maximum(code, 0), mask=depth <= k)))
        phrases = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()), null_handling="skip")
        return pa.RecordBatch.from_arrays([table["grp"].combine_chunks().take(pa.array(member)), phrases.cast(pa.string()), pa.array(f)], names=["grp", "phrase", "f"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        n, last = 0, None
        for batch in batches:
            route = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(route)) + 1).tolist(), len(route)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and route[a] != last and (n >= most_rows or (last < routes) != (route[a] < routes)):
                    yield counted(held, last >= routes)
                    held, n = [], 0
                held.append(batch.slice(a, b - a))
                n, last = n + b - a, route[a]
        if held:
            yield counted(held, last >= routes)

    sorted_rows = rows.repartition(parts, "route").sortWithinPartitions("route")
    found = sorted_rows.mapInArrow(run, "grp string, phrase string, f long")
    return found.groupBy("grp", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def count_phrases(docs: DataFrame, least: int, most_words: int, group: str = "lang", text: str = "text", hot_rows: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): grp, phrase, f of all phrases of one to ``most_words`` words that occur
    ``least`` times in a group, and grp, n: all word occurrences. See collocations.
    """
    source = docs.select(F.coalesce(F.col(group).cast("string"), F.lit(NO_GROUP)).alias("grp"), F.col(text).cast("string").alias("text"))
    words = cut(word_counts(source))
    totals = cut(words.groupBy("grp").agg(F.sum("f").alias("n")))
    total = totals.agg(F.sum("n")).first()[0] or 0
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    routes = int(min(max(8 * tasks, total // hot_rows), 1 << 29))
    often = cut(words.filter(F.col("f") >= least))
    very = often.filter(F.col("f") >= max(least, min(hot_rows, total // routes)))
    frequent, hot = filter_of(word_keys(often), "key"), filter_of(word_keys(very), "key")
    # About as many words to a task, whatever their number.
    parts = int(max(tasks, total // TASK_WORDS))
    longer = route_counts(suffixes(source, frequent, hot, most_words, routes), least, most_words, routes, parts)
    return cut(often.select("grp", F.col("word").alias("phrase"), "f").union(longer)), totals


def collocations(
    docs: DataFrame, group: str = "lang", text: str = "text", most_words: int = 3, least: int = 10, top: int = 2000, scale: int = 1_000_000, within: int = 50
) -> DataFrame:
    """The ``top`` phrases of each group by their weakest cut: grp, rank, phrase, a, l, r, n, score.

    Words are what blanks and the ends of pieces separate, with A-Z lower-cased; a null
    group is ``und``, a null or empty text has no words, repeated rows count each time.
    Candidates are phrases of 2 to ``most_words`` words that occur ``a`` >= ``least`` times. A cut
    after k words scores floor(scale * a * a / (l * r)) by the counts of its two parts;
    the lowest score counts, of equal ones the smallest k. A candidate inside a longer one
    with 100 * f(longer) >= ``within`` * a is dropped. Ties in score go to larger a, then to
    the smaller phrase by bytes. Sums are exact in decimals up to counts of 10**15. Other
    columns may have any name; empty tables give no rows.
    """
    counts, totals = count_phrases(docs, least, most_words, group, text)
    size = F.size(F.split("phrase", " ", -1))
    found = counts.select("grp", "phrase", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("w"), size.alias("size")).filter("size > 1")
    part = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("grp", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    of = lambda side, f: counts.select("grp", F.col("phrase").alias(side), F.col("f").alias(f))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    scored = cuts.join(of("left", "l"), ["grp", "left"]).join(of("right", "r"), ["grp", "right"])
    scored = scored.select(
        "grp", "phrase", "a", "l", "r", "k", wide("a").alias("wa"), wide("l").alias("wl"), wide("r").alias("wr")
    ).withColumn("score", F.expr(f"(CAST({scale} AS DECIMAL(10,0)) * wa * wa) DIV (wl * wr)"))
    weakest = scored.groupBy("grp", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best")).select("grp", "phrase", "best.*")
    inner = found.filter("size > 2").select("grp", F.col("a").alias("f"), "w", "size")
    inner = inner.withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("start", F.explode(F.expr("sequence(1, size - length + 1)")))
    longest = inner.groupBy("grp", part(F.col("start"), F.col("length")).alias("phrase")).agg(F.max("f").alias("longer"))
    kept = weakest.join(longest, ["grp", "phrase"], "left").filter(F.col("longer").isNull() | (100 * wide("longer") < within * wide("a")))
    order = Window.partitionBy("grp").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "grp").select("grp", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
