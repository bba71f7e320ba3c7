"""Vector and question-log jobs: top-k similarity, merging, contexts, scoring."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import FOLLOW_UP_WORDS, confidence_label, has_word
from tidemark.operators.ordered import place
from tidemark.operators.ranking import top_n_per_group
from tidemark.session import cut

QUESTION_BLOCK = 2048
VECTOR_PACK = 2048
HELD_ROWS = 400_000


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two array columns, in double precision."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def mean_vectors(vectors: DataFrame, key: str, column: str, dims: int) -> DataFrame:
    """Mean vector per key: one aggregate per position, combined before the shuffle."""
    means = vectors.groupBy(key).agg(
        *[F.avg(F.col(column)[i].cast("double")).alias(f"_{i}") for i in range(dims)]
    )
    return means.select(key, F.array(*[f"_{i}" for i in range(dims)]).alias(column))


def nearest(
    vectors: DataFrame,
    questions: DataFrame,
    k: int,
    ident: str = "vec_id",
    column: str = "embedding",
    question: str = "question_id",
    category: str | None = None,
    block: int = QUESTION_BLOCK,
) -> DataFrame:
    """The ``k`` most similar vectors for every question: question, ident, similarity, rank.

    ``category`` names a column on both sides that must be equal. Ties go to the smaller
    ident. Null, empty and zero vectors, those with null or non-finite values, and rows
    without ident are similar to nothing; vectors are compared with questions of their
    own length only.

    Vectors are read once, in packs, and meet the questions in blocks of at most ``block``;
    a task keeps the k best of its packs. Few questions go to the vectors by AQE's size
    check, many are joined by block, and only best lists are shuffled after that.
    """
    inside = category is not None
    found = _best(vectors, questions, k, ident, column, question, category, [inside], block)
    ranked = top_n_per_group(found, [question], [F.desc("similarity"), F.asc(ident)], k, "rank")
    return ranked.select(question, ident, "similarity", "rank")


def nearest_both(
    vectors: DataFrame,
    questions: DataFrame,
    k: int,
    category: str,
    ident: str = "vec_id",
    column: str = "embedding",
    question: str = "question_id",
    block: int = QUESTION_BLOCK,
) -> DataFrame:
    """The k most similar of all vectors and, as rows with ``inside``, the k most similar of
    the question's category, from one pass over the vectors.
    """
    found = _best(vectors, questions, k, ident, column, question, category, [False, True], block)
    order = [F.desc("similarity"), F.asc(ident)]
    ranked = top_n_per_group(found, [question, "inside"], order, k, "rank")
    return ranked.select(question, ident, "similarity", "inside", "rank")


def _best(vectors, questions, k, ident, column, question, category, ways, block) -> DataFrame:
    """(question, ident, similarity, inside): the k best of each task, for each of ``ways``."""
    asked = _question_blocks(questions, column, question, category, block)
    last = asked.agg(F.max("block")).first()[0] or 0
    packs = _packs(vectors, ident, column, category).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long")))
    )
    names = ["ids", "groups", "units", "questions", "question_groups", "question_units"]
    kinds = {question: dict(questions.dtypes)[question], ident: dict(vectors.dtypes)[ident]}
    schema = f"`{question}` {kinds[question]}, `{ident}` {kinds[ident]}, similarity double, inside boolean"

    def shrink(frames: list[pd.DataFrame]) -> pd.DataFrame:
        every = pd.concat(frames, ignore_index=True)
        every = every.sort_values(["similarity", ident], ascending=[False, True], kind="stable")
        return every.groupby([question, "inside"], sort=False).head(k)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        size = 0

        def sent(frame: pd.DataFrame) -> pa.RecordBatch:
            return pa.RecordBatch.from_pandas(frame, preserve_index=False)

        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(i)[row].values for i, c in enumerate(names)}
                ids = one["ids"].to_numpy(zero_copy_only=False)
                asks = one["questions"].to_numpy(zero_copy_only=False)
                x = one["units"].to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                y = one["question_units"].to_numpy(zero_copy_only=False).reshape(len(asks), -1)
                scores = x @ y.T
                for inside in ways:
                    if inside:
                        groups = one["groups"].to_pylist() + one["question_groups"].to_pylist()
                        code = pd.factorize(np.array(groups, dtype=object))[0]
                        mine, theirs = code[: len(ids), None], code[None, len(ids) :]
                        scores = np.where((mine == theirs) & (mine >= 0), scores, -np.inf)
                    at, to = np.nonzero(_top(scores, k))
                    held.append(
                        pd.DataFrame(
                            {question: asks[to], ident: ids[at], "similarity": scores[at, to], "inside": inside}
                        )
                    )
                    size += len(at)
                if size > HELD_ROWS:
                    held = [shrink(held)]
                    size = len(held[0])
                    if size > HELD_ROWS // 2:
                        yield sent(held.pop())
                        size = 0
        if held:
            yield sent(shrink(held))

    met = packs.join(asked, ["block", "dims"]).select(*names)
    return met.mapInArrow(search, schema)


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Marks the k best rows of each column; of equal ones the first, nothing at -inf."""
    if len(scores) <= k:
        return scores > -np.inf
    at = len(scores) - k
    floors = np.partition(scores, at, axis=0)[at]
    over = scores > floors
    ties = (scores == floors) & (floors > -np.inf)
    room = k - over.sum(axis=0)
    return over | (ties & (ties.cumsum(axis=0) <= room))


def _units(rows: DataFrame, keys: list[Column], column: str, size: int) -> DataFrame:
    """Packs of at most ``size`` rows of a batch: dims, ids, groups, and their unit vectors one
    after the other, in the order of ids.

    ``keys``: ident and category. Rows that can be similar to nothing are left out.
    """
    plain = rows.select(keys[0].alias("ids"), keys[1].alias("groups"), F.col(column).cast("array<double>").alias("v"))
    kind = dict(plain.dtypes)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
            for dims in np.unique(lengths[lengths > 0]):
                some = np.flatnonzero((lengths == dims) & batch.column(0).is_valid().to_numpy(zero_copy_only=False))
                ids = batch.column(0).take(pa.array(some))
                some = some[pc.sort_indices(ids).to_numpy()]
                for a in range(0, len(some), size):
                    part = batch.take(pa.array(some[a : a + size]))
                    x = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                    peak = np.abs(x).max(axis=1)
                    fine = np.isfinite(peak) & (peak > 0)
                    x = x[fine] / peak[fine, None]
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    part = part.filter(pa.array(fine))
                    if part.num_rows:
                        yield pa.RecordBatch.from_pydict(
                            {
                                "dims": pa.array([int(dims)], pa.int32()),
                                "ids": _as_list(part.column(0)),
                                "groups": _as_list(part.column(1)),
                                "units": _as_list(pa.array(x.reshape(-1))),
                            }
                        )

    return plain.mapInArrow(
        pack, f"dims int, ids array<{kind['ids']}>, groups array<{kind['groups']}>, units array<double>"
    )


def _as_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _group(category: str | None) -> Column:
    return F.col(category) if category else F.lit(None).cast("string")


def _packs(vectors: DataFrame, ident: str, column: str, category: str | None) -> DataFrame:
    return _units(vectors, [F.col(ident), _group(category)], column, VECTOR_PACK)


def _question_blocks(questions, column, question, category, block) -> DataFrame:
    """(block, dims, questions, question_groups, question_units), numbered in question order."""
    plain = questions.select(F.col(question).alias("ids"), _group(category).alias("groups"), F.col(column).alias("v"))
    numbered = place(plain, [], ["ids"]).running_sum(_i=F.lit(1).cast("long")).df
    single = _units(numbered.withColumn("groups", F.struct("groups", "_i")), [F.col("ids"), F.col("groups")], "v", 1)
    listed = single.select(
        F.floor((F.col("groups")[0]["_i"] - 1) / block).cast("long").alias("block"),
        "dims",
        F.struct(F.col("ids")[0].alias("id"), F.col("groups")[0]["groups"].alias("grp"), "units").alias("q"),
    )
    blocks = listed.groupBy("block", "dims").agg(F.collect_list("q").alias("q"))
    return cut(
        blocks.select(
            "block",
            "dims",
            F.col("q.id").alias("questions"),
            F.col("q.grp").alias("question_groups"),
            F.flatten("q.units").alias("question_units"),
        )
    )


def hybrid(
    semantic: DataFrame, filtered: DataFrame, question: str, item: str, keep: int
) -> DataFrame:
    """Semantic hits first, then category hits; an item once; the first ``keep``."""
    both = semantic.withColumn("_src", F.lit(0)).unionByName(filtered.withColumn("_src", F.lit(1)))
    first = both.groupBy(question, item).agg(F.min(F.struct("_src", "rank")).alias("_at"))
    return top_n_per_group(
        first, [question], [F.col("_at._src"), F.col("_at.rank"), F.col(item)], keep, "position"
    ).drop("_at")


def contexts(hits: DataFrame, question: str, position: str, text: str, joiner="\n\n") -> DataFrame:
    """One context text per question from its few ranked hits."""
    listed = F.array_sort(F.collect_list(F.struct(position, text)))
    texts = F.transform(listed, lambda s: s[text])
    return hits.groupBy(question).agg(F.array_join(texts, joiner).alias("context"))


def knowledge_rows(base: DataFrame, categories: Sequence[str]) -> DataFrame:
    """(id, category, text) from one row with an array column per category."""
    parts = [
        base.select(
            F.lit(c).alias("category"), F.posexplode(c).alias("i", "text")
        ).select(F.concat_ws("_", "category", "i").alias("doc_id"), "category", "text")
        for c in categories
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def attempt_confidence(attempts: DataFrame, question: str, attempt: str, sql: str) -> DataFrame:
    """Confidence of a question from its repeated attempts.

    1 - 0.3 per extra distinct answer; x0.9 with more than two JOINs, x0.85 with a
    sub-query, x1.1 with an aggregate function; at most 1.
    """
    per = attempts.groupBy(question, F.md5(sql).alias("_h")).agg(
        F.min(F.struct(F.col(attempt), F.col(sql).alias("sql"))).alias("_f")
    )
    first = per.groupBy(question).agg(
        F.count("*").alias("distinct_answers"), F.min("_f")["sql"].alias("sql")
    )
    text = F.col("sql")
    score = F.lit(1.0) - (F.col("distinct_answers") - 1) * F.lit(0.3)
    score = score * F.when(F.regexp_count(text, F.lit("JOIN")) > 2, 0.9).otherwise(1.0)
    score = score * F.when(text.rlike(r"(?s)\(.*SELECT"), 0.85).otherwise(1.0)
    score = score * F.when(F.upper(text).rlike("SUM|COUNT|AVG"), 1.1).otherwise(1.0)
    capped = F.least(score, F.lit(1.0))
    return first.withColumn("confidence", capped).withColumn("band", confidence_label(capped))


def accuracy(predicted: DataFrame, expected: DataFrame, key: str, value: str) -> DataFrame:
    """Cases, correct and failed ones, compared with the expected outcome."""
    both = expected.select(key, F.col(value).alias("want")).join(
        predicted.select(key, F.col(value).alias("got")), key, "left"
    )
    right = F.col("want").eqNullSafe(F.col("got"))
    return both.agg(
        F.count("*").alias("cases"),
        F.count_if(right).alias("correct"),
        F.count_if(~right).alias("failed"),
        ratio_of(F.count_if(right), F.count("*")).alias("accuracy"),
    )


def ratio_of(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def failures(predicted: DataFrame, expected: DataFrame, key: str, value: str) -> DataFrame:
    both = expected.select(key, F.col(value).alias("want")).join(
        predicted.select(key, F.col(value).alias("got")), key, "left"
    )
    return both.filter(~F.col("want").eqNullSafe(F.col("got")))


def cache_stats(log: DataFrame, cache_key: Column) -> DataFrame:
    """A request is a hit when its key was asked before: hits = requests - distinct keys.

    Counting replaces ordering, so a key asked by a third of all requests is combined
    before the shuffle.
    """
    per_key = log.groupBy(cache_key.alias("k")).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum("n").alias("requests"),
        F.sum(F.col("n") - 1).alias("hits"),
        F.count("*").alias("misses"),
        ratio_of(F.sum(F.col("n") - 1), F.sum("n")).alias("hit_rate"),
    )


def follow_ups(turns: DataFrame, conv: str, turn: str, text: str, **how) -> DataFrame:
    """Turns that refer back, with the previous question of their conversation."""
    ordered = place(turns.select(conv, turn, text), [conv], [turn], **how)
    near = ordered.previous(previous_text=F.col(text)).df
    return near.filter(has_word(F.col(text), FOLLOW_UP_WORDS) & F.col("previous_text").isNotNull())


def approved_examples(feedback: DataFrame) -> DataFrame:
    """Feedback rows marked correct, as example texts."""
    line = F.concat(F.lit("Q: "), "question", F.lit(" | SQL: "), "sql")
    return feedback.filter("correct").select(
        F.md5(line).alias("doc_id"), F.lit("examples").alias("category"), line.alias("text")
    )
