"""Probabilistic record linkage: blocks, scored comparisons, weights learnt without labels.

Pairs that share a block are compared rule by rule; each rule's score falls into a level.
The levels of all rules are the pair's pattern, and the number of pairs of each pattern is
all that the estimation needs, so it runs on a small table however many pairs there are.

Where all scores have a form for whole blocks of values, pairs are counted or picked by
pattern inside tasks, and only the counts or the picked pairs become rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import pairlevels as P
from tidemark.operators.similarity import BLOCK_ROWS, meeting
from tidemark.session import cut


@dataclass(frozen=True)
class MatchRule:
    """How two records are compared on one matter.

    ``value`` is taken from each record, ``score`` says how alike two values are (more is
    more alike; NULL: cannot tell), ``levels`` are rising scores that make the pair's level:
    0 below the first, n from the n-th on. ``weights`` fixes the weight of each level (0 to
    n); without them they are learnt. ``blocking`` is a key (or array of keys) of the
    record: pairs that share a key of any rule are compared; NULL is no key.
    """

    name: str
    value: Column
    score: Callable[[Column, Column], Column]
    levels: tuple[float, ...] = (1.0,)
    weights: tuple[float, ...] | None = None
    blocking: Column | None = None


@dataclass(frozen=True)
class Score:
    """A score of columns that also has a form for all pairs of a block at once.

    ``block`` takes the levels and the values of a block; it serves values of ``kinds``.
    """

    column: Callable[[Column, Column], Column]
    block: Callable
    kinds: tuple[str, ...]

    def __call__(self, a: Column, b: Column) -> Column:
        return self.column(a, b)


def _equal(a: Column, b: Column) -> Column:
    return (a == b).cast("double")


def _edit_similarity(a: Column, b: Column) -> Column:
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longer)


equal = Score(_equal, P.Equal, ("string", "tinyint", "smallint", "int", "bigint", "date"))

#: 1 for equal texts, less by each edit over the longer length.
edit_similarity = Score(_edit_similarity, P.Edits, ("string",))


def closeness(width: float) -> Callable[[Column, Column], Column]:
    """1 for equal numbers, 0 from ``width`` apart."""
    column = lambda a, b: F.greatest(F.lit(0.0), 1 - F.abs(a - b) / width)
    return Score(column, partial(P.Near, float(width)), ("tinyint", "smallint", "int", "float", "double")) if width > 0 else column


class Pairs:
    """The pairs of ``compared``: a frame that makes each pair when it is used, and the
    record classes it is made of, by which pairs are counted or picked without a row each."""

    def __init__(self, frame: DataFrame, folded: DataFrame, rules: Sequence[MatchRule], keys: Sequence[str], single: bool, block: int | None):
        self.frame, self.folded, self.rules, self.keys = frame, folded, rules, keys
        self.single, self.block = single, block or P.WIDTH
        self._fits: bool | None = None

    def __getattr__(self, name: str):
        return getattr(self.frame, name)

    def in_blocks(self) -> bool:
        """Whether every rule has a block form for its values, and each record one key a rule."""
        if self._fits is None:
            kinds = dict(self.folded.dtypes)
            self._fits = self.single and math.prod(self._bases()) < 1 << 16 and all(
                isinstance(r.score, Score) and kinds[f"v_{r.name}"] in r.score.kinds for r in self.rules
            )
            texts = [F.col(f"v_{r.name}") for r in self.rules if r.score is edit_similarity]
            if self._fits and texts:
                short = [F.coalesce(F.bool_and((F.length(t) <= P.LONGEST) & F.is_valid_utf8(t)), F.lit(True)) for t in texts]
                self._fits = all(self.folded.agg(*[c.alias(f"c{k}") for k, c in enumerate(short)]).first())
        return self._fits

    def counted(self) -> DataFrame:
        """level_<rule>... and copies: few rows for each pattern, that add up to all pairs'."""
        if not self.in_blocks():
            return self.frame
        most = math.prod(self._bases()) + 1

        def count(batches):
            total = np.zeros(most, np.int64)
            for rows, group in met(batches):
                n = rows.column("n").to_numpy()
                for right, left, codes in group.tiles():
                    if (n == 1).all():
                        total += np.bincount(codes.ravel(), minlength=most)
                    else:
                        each = n[right, None] * n[None, left]
                        total += np.bincount(codes.ravel(), each.ravel(), most).astype(np.int64)
            some = np.flatnonzero(total[1:]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["code", "copies"])

        met = self._met()
        found = self._tasks().mapInArrow(count, "code int, copies long")
        return found.select(*self._levels(), "copies").unionByName(self._alone().drop("left", "right"))

    def picked(self, wanted: Callable[[dict[str, np.ndarray]], np.ndarray]) -> DataFrame:
        """The pairs of wanted patterns; ``wanted`` gets the levels of all patterns."""
        if not self.in_blocks():
            return self.frame
        codes = np.arange(math.prod(self._bases()))
        levels = {r.name: codes // place % base - 1 for r, place, base in self._places()}
        take = np.append(False, wanted(levels))
        kind = T.StructType([T.StructField(c, self.folded.schema["rep"].dataType) for c in ("a", "b")])
        kind = kind.add("copies", T.LongType()).add("code", T.IntegerType())

        def pick(batches):
            for rows, group in met(batches):
                n, reps = rows.column("n").to_numpy(), rows.column("rep").combine_chunks()
                for right, left, codes in group.tiles():
                    at = np.flatnonzero(take[codes])
                    if len(at):
                        a, b = at // codes.shape[1] + right.start, at % codes.shape[1] + left.start
                        code = pa.array(codes.ravel()[at].astype(np.int32))
                        yield pa.RecordBatch.from_arrays([reps.take(pa.array(a)), reps.take(pa.array(b)), pa.array(n[a] * n[b]), code], names=["a", "b", "copies", "code"])

        met = self._met()
        found = self._tasks().mapInArrow(pick, kind)
        ends = [F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right")]
        return found.select(*ends, "copies", *self._levels()).unionByName(self._alone())

    def _bases(self) -> list[int]:
        return [len(r.levels) + 2 for r in self.rules]

    def _places(self) -> list[tuple[MatchRule, int, int]]:
        bases = self._bases()
        return [(r, math.prod(bases[k + 1 :]), base) for k, (r, base) in enumerate(zip(self.rules, bases))]

    def _levels(self) -> list[Column]:
        """The levels that a pattern's code stands for."""
        return [F.expr(f"CAST((code - 1) DIV {place} % {base} - 1 AS INT)").alias(f"level_{r.name}") for r, place, base in self._places()]

    def _alone(self) -> DataFrame:
        return _leveled(_copies(self.folded, self.rules, self.keys), self.rules)

    def _tasks(self) -> DataFrame:
        """Rows of classes by rule, key and pair of blocks (i, j), the keys of earlier rules with them."""
        folded = self.folded
        ones = [F.get(k, F.lit(0)) for k in self.keys]
        postings = None
        for k, one in enumerate(ones):
            earlier = [(x if e < k else F.lit(None).cast("string")).alias(f"e{e}") for e, x in enumerate(ones[:-1])]
            values = [F.col(f"v_{r.name}").alias(f"v{v}") for v, r in enumerate(self.rules)]
            part = folded.select(F.lit(k).alias("rule"), one.alias("sign"), "rep", "n", *values, *earlier).filter("sign IS NOT NULL")
            postings = part if postings is None else postings.unionByName(part)
        counts = postings.groupBy("rule", "sign").agg(F.count("*").alias("_n")).filter("_n > 1")
        blocks = counts.select("rule", "sign", F.ceil(F.col("_n") / self.block).cast("int").alias("_blocks"))
        own = F.pmod(F.xxhash64(F.lit(17), "rep"), F.col("_blocks")).cast("int")
        dealt = postings.join(blocks, ["rule", "sign"]).withColumn("_own", own)
        both = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        sides = both.withColumns({"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other"), "second": F.col("_own") > F.col("_other")})
        # Pairs are far more than rows: dealt by the size of the rows, few tasks would make them all.
        session = folded.sparkSession
        parts = max(int(session.conf.get("spark.sql.shuffle.partitions")), 4 * session.sparkContext.defaultParallelism)
        keys = ["rule", "sign", "i", "j"]
        return sides.drop("_blocks", "_own", "_other").repartition(parts, *keys).sortWithinPartitions(*keys, "second")

    def _met(self) -> Callable:
        """From a task's rows to its groups, with their rows."""
        makers, bases = [partial(r.score.block, tuple(r.levels)) for r in self.rules], self._bases()
        earlier = [f"e{k}" for k in range(len(self.keys) - 1)]

        def make(rows: pa.Table, split: int | None, several: np.ndarray | None) -> P.Group:
            return P.Group(rows, makers, bases, earlier, split, several)

        return lambda batches: P.groups(batches, ["rule", "sign", "i", "j"], make)


def compared(records: DataFrame, ident: str, rules: Sequence[MatchRule], block: int | None = None) -> tuple[Pairs, DataFrame]:
    """(pairs, classes): every pair of record classes that shares a block, with its pattern.

    Records with equal values and blocks are one class (class_id: smallest ident; copies),
    so copies are compared once. ``pairs``: left, right, copies (record pairs they stand
    for) and level_<rule> (-1 where the score is NULL); a class of several records also
    meets itself. A pair that shares several blocks is there once. ``classes``: ident,
    class_id. Records with a null ident are left out. Pairs grow with the square of a block
    and are not stored: each use compares them anew, so filter or count them at once, best
    by ``patterns`` and ``reaching``. A key's records meet in blocks of about ``block``.
    """
    blocking = [r for r in rules if r.blocking is not None]
    if not blocking:
        raise ValueError("no rule has a blocking key")
    keyed = records.filter(F.col(ident).isNotNull()).select(
        F.col(ident).alias("ident"),
        *[r.value.alias(f"v_{r.name}") for r in rules],
        *[_keys(records, r).alias(f"b_{r.name}") for r in blocking],
    )
    keyed = cut(keyed)
    keys = [f"b_{r.name}" for r in blocking]
    same_class = [*[f"v_{r.name}" for r in rules], *keys]
    folded = cut(keyed.groupBy(*same_class).agg(F.min("ident").alias("rep"), F.count("*").alias("n")))
    same = [F.col(f"k.{c}").eqNullSafe(F.col(f"f.{c}")) for c in same_class]
    classes = keyed.alias("k").join(folded.alias("f"), same).select(F.col("ident").alias(ident), F.col("rep").alias("class_id"))
    met = None
    for k, key in enumerate(keys):
        # A pair is met under the first rule of which it shares a block.
        pairs = meeting(folded.filter(F.size(key) > 0), "rep", key, block or BLOCK_ROWS)
        for earlier in keys[:k]:
            pairs = pairs.filter(~_share(F.col(f"left_{earlier}"), F.col(f"right_{earlier}")))
        met = pairs if met is None else met.unionByName(pairs)
    pairs = met.withColumn("copies", F.col("left_n") * F.col("right_n"))
    alone = _copies(folded, rules, keys)
    both = pairs.withColumnsRenamed({"left_rep": "left", "right_rep": "right"}).select(*alone.columns).unionByName(alone)
    single = not any(records.select(r.blocking.alias("b")).dtypes[0][1].startswith("array") for r in blocking)
    return Pairs(_leveled(both, rules), folded, rules, keys, single, block), classes


def _copies(folded: DataFrame, rules: Sequence[MatchRule], keys: Sequence[str]) -> DataFrame:
    """Classes of several records that have a key, met with themselves."""
    keyed = reduce(lambda a, b: a | b, [F.size(k) > 0 for k in keys])
    return folded.filter((F.col("n") > 1) & keyed).select(
        F.col("rep").alias("left"), F.col("rep").alias("right"), F.expr("n * (n - 1) DIV 2").alias("copies"),
        *[F.col(f"v_{r.name}").alias(f"{side}_v_{r.name}") for r in rules for side in ("left", "right")],
    )


def _keys(records: DataFrame, rule: MatchRule) -> Column:
    """The rule's block keys as sorted texts without repeats; none for NULL."""
    kind = records.select(rule.blocking.alias("b")).schema["b"].dataType.simpleString()
    keys = rule.blocking if kind.startswith("array") else F.array(rule.blocking)
    keys = F.array_compact(F.coalesce(keys.cast("array<string>"), F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(keys))


def _share(a: Column, b: Column) -> Column:
    """Whether two arrays have a common key; single keys are compared without a set."""
    single = (F.size(a) == 1) & (F.size(b) == 1)
    return F.when(single, a[0] == b[0]).otherwise(F.arrays_overlap(a, b))


def _leveled(pairs: DataFrame, rules: Sequence[MatchRule]) -> DataFrame:
    """left, right, copies and level_<rule> of each pair."""
    kept = ["left", "right", "copies"]
    scores = [r.score(F.col(f"left_v_{r.name}"), F.col(f"right_v_{r.name}")).cast("double").alias(f"s_{r.name}") for r in rules]
    # Unfolded from an array, a score is computed once per pair; as a plain column the
    # optimizer would copy it into every level, weight and filter made of it.
    scored_ = pairs.select(*kept, F.inline(F.array(F.struct(*scores))))
    return scored_.select(*kept, *[_level(r, F.col(f"s_{r.name}")) for r in rules])


def _level(rule: MatchRule, score: Column) -> Column:
    # Scores come from divisions: a score just under a level by rounding reaches it.
    reached = sum((score >= x - 1e-9).cast("int") for x in rule.levels)
    return F.when(score.isNull(), F.lit(-1)).otherwise(reached).alias(f"level_{rule.name}")


def patterns(pairs: DataFrame | Pairs, rules: Sequence[MatchRule]) -> DataFrame:
    """Record pairs of each pattern: level_<rule>..., pairs. At most one row per pattern."""
    counted = pairs.counted() if isinstance(pairs, Pairs) else pairs
    return counted.groupBy(*[f"level_{r.name}" for r in rules]).agg(F.sum("copies").alias("pairs"))


@dataclass(frozen=True)
class Model:
    """Shares of each level among matches (m) and others (u), and the share of matches."""

    rules: tuple[str, ...]
    m: tuple[tuple[float, ...], ...]
    u: tuple[tuple[float, ...], ...]
    prior: float

    def weights(self) -> dict[str, list[float]]:
        """log2(m / u) of each level of each rule."""
        return {r: [math.log2(a / b) for a, b in zip(m, u)] for r, m, u in zip(self.rules, self.m, self.u)}


def learn(counted: DataFrame, rules: Sequence[MatchRule], prior: float = 0.05, rounds: int = 500, smooth: float = 1e-6) -> Model:
    """Expectation-maximisation over the patterns: two kinds of pairs, rules independent in each.

    ``counted`` (from patterns) has at most one row per pattern, the product of the numbers
    of levels, and is all that reaches the driver. A rule that cannot tell (-1) says nothing.
    Fixed weights of a rule are not used here. Starts from agreement being likelier among
    matches, so that the kind with more agreement is the match.
    """
    most = math.prod(len(r.levels) + 2 for r in rules)
    rows = counted.limit(most + 1).collect()
    names = [f"level_{r.name}" for r in rules]
    levels = np.array([[row[n] for n in names] for row in rows], np.int64).reshape(-1, len(rules))
    n = np.array([row["pairs"] for row in rows], np.float64)
    sizes = [len(r.levels) + 1 for r in rules]
    m = [np.linspace(1, 9, s) / np.linspace(1, 9, s).sum() for s in sizes]
    u = [x[::-1].copy() for x in m]
    for _ in range(rounds if len(rows) else 0):
        log_m, log_u = np.full(len(n), math.log(prior)), np.full(len(n), math.log(1 - prior))
        for k in range(len(rules)):
            said = levels[:, k] >= 0
            log_m[said] += np.log(m[k][levels[said, k]])
            log_u[said] += np.log(u[k][levels[said, k]])
        match = 1 / (1 + np.exp(np.clip(log_u - log_m, -700, 700)))
        before = (prior, m, u)
        prior = float(np.clip((match * n).sum() / n.sum(), 1e-9, 1 - 1e-9))
        m, u = [], []
        for k, size in enumerate(sizes):
            said = levels[:, k] >= 0
            for part, out in ((match, m), (1 - match, u)):
                share = np.bincount(levels[said, k], part[said] * n[said], minlength=size) + smooth
                out.append(share / share.sum())
        moved = max(np.abs(np.concatenate(m) - np.concatenate(before[1])).max(), np.abs(np.concatenate(u) - np.concatenate(before[2])).max())
        if moved < 1e-12:
            break
    as_tuples = lambda x: tuple(tuple(float(v) for v in part) for part in x)
    return Model(tuple(r.name for r in rules), as_tuples(m), as_tuples(u), prior)


def _all_weights(rules: Sequence[MatchRule], model: Model | None) -> dict[str, list[float]]:
    learnt = model.weights() if model else {}
    out = {}
    for r in rules:
        if r.weights is None and r.name not in learnt:
            raise ValueError(f"rule {r.name} has no weights: give them or learn a model")
        out[r.name] = list(r.weights) if r.weights is not None else learnt[r.name]
    return out


def scored(pairs: DataFrame, rules: Sequence[MatchRule], model: Model | None = None) -> DataFrame:
    """Adds weight: the sum of the levels' weights, fixed or learnt; -1 adds nothing."""
    total = F.lit(0.0)
    for name, weights in _all_weights(rules, model).items():
        level = F.col(f"level_{name}")
        total = total + F.when(level >= 0, F.element_at(F.array(*[F.lit(float(w)) for w in weights]), level + 1)).otherwise(0.0)
    return pairs.withColumn("weight", total)


def reaching(pairs: DataFrame | Pairs, rules: Sequence[MatchRule], model: Model | None, threshold: float) -> DataFrame:
    """The pairs whose weight reaches the threshold, with it."""
    weights = _all_weights(rules, model)

    def heavy(levels: dict[str, np.ndarray]) -> np.ndarray:
        total = 0.0
        for name, by_level in weights.items():
            total = total + np.append(by_level, 0.0)[levels[name]]  # the last place, -1, adds nothing
        return total >= threshold

    found = pairs.picked(heavy) if isinstance(pairs, Pairs) else pairs
    return scored(found, rules, model).filter(F.col("weight") >= threshold)


def threshold_for(counted: DataFrame, rules: Sequence[MatchRule], model: Model, precision: float = 0.95) -> dict[str, float]:
    """The smallest weight at which the model expects this share of the linked pairs to match:
    threshold, and the precision and recall expected there. Infinite if none reaches it.

    Pairs with a weight w match with odds 2**w times the prior odds.
    """
    most = math.prod(len(r.levels) + 2 for r in rules)
    rows = scored(counted, rules, model).select("weight", "pairs").limit(most + 1).collect()
    weight, n = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows], float)
    match = 1 / (1 + (1 - model.prior) / model.prior * np.exp2(-np.clip(weight, -900, 900)))
    best = {"threshold": math.inf, "precision": 1.0, "recall": 0.0}
    total = float((match * n).sum())
    for w in sorted(set(weight.tolist()), reverse=True):
        linked = weight >= w
        found, expected = float(n[linked].sum()), float((match * n)[linked].sum())
        if found and expected / found >= precision:
            best = {"threshold": w, "precision": expected / found, "recall": expected / total if total else 0.0}
    return best


def link_records(
    records: DataFrame, ident: str, rules: Sequence[MatchRule], threshold: float | None = None, precision: float = 0.95
) -> tuple[DataFrame, DataFrame, Model | None]:
    """(links, classes, model): class pairs whose weight reaches the threshold, with level_<rule>.

    Without a threshold the smallest weight with the expected precision is taken. Weights
    are learnt unless every rule has its own.
    """
    pairs, classes = compared(records, ident, rules)
    model = None
    if threshold is None or not all(r.weights for r in rules):
        counted = cut(patterns(pairs, rules))
        model = learn(counted, rules)
        if threshold is None:
            threshold = threshold_for(counted, rules, model, precision)["threshold"]
    return reaching(pairs, rules, model, threshold), classes, model


def every_pattern(rules: Sequence[MatchRule]) -> list[tuple[int, ...]]:
    """All level combinations that pairs without unknown scores can have."""
    return list(product(*[range(len(r.levels) + 1) for r in rules]))
