"""Similarity joins, record linkage and vector cells against all pairs."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import cells as C
from tidemark.operators import linkage as L
from tidemark.operators import setpairs
from tidemark.operators import similarity as S


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def some_texts(n, seed):
    rng = random.Random(seed)
    words = ["anna", "hannah", "jonathan", "jon", "maria-louise", "a", "", "ab", "北京市", "smith & sons limited"]
    out = []
    for _ in range(n):
        t = list(rng.choice(words))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(t))
            if rng.random() < 0.5 and t:
                t.pop(min(at, len(t) - 1))
            else:
                t.insert(at, rng.choice("abn "))
        out.append("".join(t))
    return out


@pytest.mark.parametrize("most, q, block", [(1, 2, 512), (2, 2, 7), (2, 3, 512)])
def test_texts_within_edits(spark, monkeypatch, most, q, block):
    monkeypatch.setattr(S.meeting, "__defaults__", (block,))
    texts = some_texts(120, most * 10 + q)
    rows = [(k, t, 1) for k, t in enumerate(texts)] + [(None, "ann", 1), (500, None, 1)]
    links, members = S.similar_texts(spark.createDataFrame(rows, "id long, t string, rep int"), "id", F.col("t"), most, q)
    first = {}
    for k, t in enumerate(texts):
        first.setdefault(t, k)
    want = sorted((min(i, j), max(i, j), edits(a, b)) for a, i in first.items() for b, j in first.items() if i < j and edits(a, b) <= most)
    assert sorted(tuple(r) for r in links.collect()) == want
    assert len(want) > 20
    assert sorted((r.id, r.representative, r.copies) for r in members.collect()) == [(k, first[t], texts.count(t)) for k, t in enumerate(texts)]


@pytest.mark.parametrize("threshold, block", [(0.5, 512), (0.8, 5), (1.0, 512)])
def test_sets_above_a_threshold(spark, monkeypatch, threshold, block):
    monkeypatch.setattr(S.meeting, "__defaults__", (block,))
    rng = np.random.default_rng(4)
    sets = [sorted({f"t{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 9)) % 12}) for _ in range(90)]
    rows = [(k, s + s[:1]) for k, s in enumerate(sets)] + [(200, None), (201, ["x", None])]
    links, members = S.similar_sets(spark.createDataFrame(rows, "id long, t array<string>"), "id", F.col("t"), threshold)
    first = {}
    for k, s in enumerate([*sets]):
        if s:
            first.setdefault(tuple(s), k)
    first[("x",)] = 201
    want = []
    for a, i in first.items():
        for b, j in first.items():
            alike = len({*a} & {*b}) / len({*a} | {*b})
            if i < j and alike >= threshold:
                want.append((i, j, round(alike, 9)))
    assert sorted((r.left, r.right, round(r.similarity, 9)) for r in links.collect()) == sorted(want)
    assert members.count() == sum(1 for s in sets if s) + 1


@pytest.mark.parametrize("threshold, block", [(0.2, 4096), (0.2, 7), (0.8, 7)])
def test_sets_counted_in_blocks_equal_those_by_signs(spark, monkeypatch, threshold, block):
    """A low threshold no longer has nearly all pairs meet under signs one by one."""
    monkeypatch.setattr(S._counted_links, "__defaults__", (block, 1 << 22))
    rng = np.random.default_rng(5)
    rows = [(f"r{k}", [f"t{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 9)) % 12]) for k in range(70)]
    df = spark.createDataFrame(rows, "id string, t array<string>")
    ways = [S.similar_sets(df, "id", F.col("t"), threshold, by_signs=way)[0].collect() for way in (True, False)]
    met, counted = [sorted((r.left, r.right, r.similarity) for r in way) for way in ways]
    assert met == counted and len(met) > 1


@pytest.mark.parametrize("threshold", [0.2, 0.5, 1.0])
@pytest.mark.parametrize("most", [25, 600])
def test_pairs_of_blocks_of_sets_equal_all_pairs(threshold, most):
    """Tokens of both kinds, sets of one token to more than 255, and blocks without rows."""
    rng = np.random.default_rng(most)
    pool = np.arange(1500)
    sets = [set(rng.choice(pool[: int(rng.choice([20, 300, 1500]))], min(20, int(rng.integers(1, most))), replace=False).tolist()) for _ in range(120)]
    sets += [set(rng.permutation(pool)[: int(rng.integers(1, most))].tolist()) | set(range(most // 2)) for _ in range(40)]
    schema = pa.schema({"rep": pa.int64(), "size": pa.int32(), "codes": pa.list_(pa.int64())})
    # One token more that no other set has is in the size only.
    table = lambda a, b: pa.Table.from_pylist([{"rep": k, "size": len(sets[k]) + 1, "codes": [*sets[k]]} for k in range(a, b)], schema)
    blocks = [setpairs.Block(table(a, b)) for a, b in ((0, 70), (70, 160), (0, 0))]
    got = []
    for i, left in enumerate(blocks):
        for right in blocks[i:]:
            for a, b, alike in setpairs.similar(left, right, threshold):
                pairs = zip(left.reps.take(pa.array(a)).to_pylist(), right.reps.take(pa.array(b)).to_pylist(), alike.tolist())
                got += [(min(a, b), max(a, b), x) for a, b, x in pairs]
    want = []
    for b in range(len(sets)):
        for a in range(b):
            k = len(sets[a] & sets[b])
            if k and k / (len(sets[a]) + len(sets[b]) + 2 - k) >= threshold:
                want.append((a, b, k / (len(sets[a]) + len(sets[b]) + 2 - k)))
    assert sorted(got) == sorted(want)
    assert want or threshold == 1


@pytest.mark.parametrize("block", [4096, 5])
def test_each_set_is_kept_once_however_many_blocks(spark, monkeypatch, tmp_path, block):
    """Disk grows with the sets, not with their pairs of blocks."""
    monkeypatch.setattr(S._counted_links, "__defaults__", (block, 1 << 22))
    folder = f"{tmp_path}/blocks"
    monkeypatch.setattr(S, "fresh_path", lambda *_: folder)
    df = spark.range(60).select("id", F.array(F.lit("all"), F.concat(F.lit("t"), F.col("id") % 20), F.concat(F.lit("own"), "id")).alias("t"))
    links = S.similar_sets(df, "id", F.col("t"), 0.4, by_signs=False)[0]
    assert links.count() == 20 * 3 and {r.similarity for r in links.collect()} == {0.5}
    kept = spark.read.parquet(folder)
    assert kept.count() == 60 and (kept.select("block").distinct().count() > 5 or block == 4096)
    assert "Generate" not in links._jdf.queryExecution().executedPlan().toString()


def test_prefix_size():
    assert [S.prefix_size(n, 0.8) for n in (1, 5, 10)] == [1, 2, 3]


def test_a_hot_sign_is_cut_into_blocks(spark):
    rows = spark.range(3000).select("id", F.array(F.lit("same")).alias("signs"))
    pairs = S.meeting(rows, "id", "signs")
    assert pairs.count() == 3000 * 2999 // 2
    per = pairs.agg(F.count_distinct(F.struct("left_id", "right_id")).alias("n"), F.min(F.expr("right_id - left_id")).alias("d")).first()
    assert (per["n"], per["d"]) == (3000 * 2999 // 2, 1)


# --- linkage -----------------------------------------------------------------------


def planted(n=400, seed=3):
    """Every third record has a second one that agrees with these chances."""
    rng = random.Random(seed)
    rows, truth = [], set()
    for k in range(n):
        one = (k, f"p{rng.randrange(40)}", f"name{rng.randrange(200)}", rng.choice(["m", "f"]), rng.randrange(50))
        rows.append(one)
        if k % 3 == 0:
            two = (n + k, one[1], one[2] if rng.random() < 0.95 else f"name{rng.randrange(200)}",
                   one[3] if rng.random() < 0.9 else None, one[4] if rng.random() < 0.8 else rng.randrange(50))
            rows.append(two)
            truth.add((k, n + k))
    return rows, truth


def rules(age_blocks=False):
    return [
        L.MatchRule("name", F.col("name"), L.equal, blocking=F.col("place")),
        L.MatchRule("sex", F.col("sex"), L.equal),
        L.MatchRule("age", F.col("age"), L.closeness(10.0), (0.5, 1.0), blocking=F.col("age") if age_blocks else None),
    ]


RECORDS = "id long, place string, name string, sex string, age int"


def test_weights_are_learnt_from_planted_matches(spark):
    rows, truth = planted()
    records = spark.createDataFrame(rows, RECORDS)
    links, classes, model = L.link_records(records, "id", rules(), precision=0.9)
    shares = dict(zip(model.rules, model.m))
    assert abs(shares["name"][1] - 0.95) < 0.06 and abs(shares["sex"][1] - 1.0) < 0.05 and abs(shares["age"][2] - 0.8) < 0.1
    chance = dict(zip(model.rules, model.u))
    assert chance["name"][1] < 0.03 and abs(chance["sex"][1] - 0.5) < 0.05
    weights = model.weights()
    assert weights["name"][1] > weights["sex"][1] > 0 > weights["name"][0]
    found = {(r.left, r.right): r.copies for r in links.collect()}
    of = {r.id: r.class_id for r in classes.collect()}  # equal records are one class
    hit = sum((of[a], of[b]) in found for a, b in truth)
    assert hit / len(truth) > 0.85 and hit / sum(found.values()) > 0.85
    assert classes.count() == len(rows)


def test_pairs_and_patterns_equal_all_pairs(spark):
    rows, _ = planted(60, 5)
    rows += [(1000 + k, "p1", "name1", "m", 7) for k in range(5)] + [(None, "p1", "name1", "m", 7), (2000, None, "name1", None, None)]
    pairs, classes = L.compared(spark.createDataFrame(rows, RECORDS), "id", rules(True), block=3)
    want, n = {}, 0
    known = [r for r in rows if r[0] is not None]
    for i, a in enumerate(known):
        for b in known[i + 1 :]:
            if (a[1] is not None and a[1] == b[1]) or (a[4] is not None and a[4] == b[4]):
                same = lambda x, y: -1 if x is None or y is None else int(x == y)
                near = -1 if a[4] is None or b[4] is None else (1 - abs(a[4] - b[4]) / 10 >= 0.5) + (a[4] == b[4])
                key = (same(a[2], b[2]), same(a[3], b[3]), int(near))
                want[key] = want.get(key, 0) + 1
                n += 1
    got = {(r.level_name, r.level_sex, r.level_age): r.pairs for r in L.patterns(pairs, rules(True)).collect()}
    assert got == want and sum(got.values()) == n
    assert sorted(r.id for r in classes.collect()) == sorted(r[0] for r in known)
    assert pairs.count() < n  # the five copies are one class


def test_threshold_and_fixed_weights(spark):
    rows, _ = planted()
    counted = L.patterns(L.compared(spark.createDataFrame(rows, RECORDS), "id", rules())[0], rules())
    model = L.learn(counted, rules())
    loose, strict = (L.threshold_for(counted, rules(), model, p) for p in (0.5, 0.95))
    assert loose["threshold"] <= strict["threshold"] and loose["recall"] >= strict["recall"]
    assert L.threshold_for(counted.limit(0), rules(), L.learn(counted.limit(0), rules()))["threshold"] == math.inf
    fixed = [L.MatchRule("name", F.col("name"), L.equal, weights=(-1.0, 5.0), blocking=F.col("place"))]
    links, _, none = L.link_records(spark.createDataFrame(rows, RECORDS), "id", fixed, threshold=5.0)
    assert none is None and {r.weight for r in links.collect()} == {5.0}
    with pytest.raises(ValueError):
        L.scored(links, rules())
    assert len(L.every_pattern(rules())) == 12


def odd_records(spark, n=150):
    rng = random.Random(8)
    names = some_texts(n, 8)
    rows = [
        (k if k % 40 else 1, rng.choice(["p", "q", "", None]), None if k % 11 == 0 else names[k], rng.choice(["m", "f", None]), rng.choice([None, math.nan, math.inf, 0.0, 3.0, 4.5, 9.0, 10.5]))
        for k in range(n)
    ]
    return spark.createDataFrame(rows + rows[:20] + [(None, "p", "ann", "m", 1.0)], "id long, place string, name string, sex string, age double")


def odd_rules():
    return [
        L.MatchRule("name", F.col("name"), L.edit_similarity, (0.4, 0.7, 1.0), blocking=F.substring("name", -2, 2)),
        L.MatchRule("sex", F.col("sex"), L.equal, blocking=F.concat_ws("|", "sex", "place")),
        L.MatchRule("age", F.col("age"), L.closeness(10.0), (0.0, 0.55, 0.9)),
    ]


@pytest.mark.parametrize("block", [None, 7])
def test_patterns_of_blocks_equal_those_of_single_pairs(spark, block):
    """Nulls, empty and long texts, NaN, copies, and idents that several classes have."""
    records = odd_records(spark)
    levels = [f"level_{r.name}" for r in odd_rules()]
    pairs, _ = L.compared(records.filter("id <> 1"), "id", odd_rules(), block)
    one_by_one = pairs.frame.groupBy(*levels).agg(F.sum("copies").alias("pairs"))
    want = sorted(tuple(r) for r in one_by_one.collect())
    assert pairs.in_blocks()
    assert sorted(tuple(r) for r in L.patterns(pairs, odd_rules()).collect()) == want
    assert len(want) > 20 and {r[0] for r in want} == {-1, 0, 1, 2, 3}
    # Classes of one ident are not paired; the others are, once.
    shared, _ = L.compared(records.filter("id = 1"), "id", odd_rules(), block)
    assert shared.counted().filter("copies > 0").count() == shared.frame.filter("left = right").count()


@pytest.mark.parametrize("block, threshold", [(None, 3.0), (7, 3.0), (7, -2.0), (None, 99.0)])
def test_links_of_blocks_equal_those_of_single_pairs(spark, block, threshold):
    weights = [(-2.0, 0.5, 1.0, 3.0), (-1.0, 2.0), (-1.5, 0.25, 1.0, 2.0)]
    rule = [L.MatchRule(r.name, r.value, r.score, r.levels, w, r.blocking) for r, w in zip(odd_rules(), weights)]
    records = odd_records(spark).filter("id <> 1")
    pairs, _ = L.compared(records, "id", rule, block)
    one_by_one = L.scored(pairs.frame, rule).filter(F.col("weight") >= threshold).collect()
    picked = L.reaching(pairs, rule, None, threshold)
    assert sorted(map(tuple, picked.collect())) == sorted(map(tuple, one_by_one))
    assert picked.columns == L.scored(pairs.frame, rule).columns
    assert (len(one_by_one) > 50) == (threshold < 99)
    named = records.withColumn("id", F.concat(F.lit("r"), "id"))
    links = L.link_records(named, "id", rule, threshold)[0]
    assert links.count() == len(one_by_one) and links.filter("left > right").isEmpty()


def test_only_linked_pairs_become_rows(spark):
    """A block of 30,000 records, 450 million pairs, of which 29,000 reach the threshold."""
    df = spark.range(30_000).select("id", F.format_string("n%05d", F.col("id") % 1000).alias("name"), (F.col("id") * 1.0).alias("x"))
    rule = [
        L.MatchRule("name", F.col("name"), L.edit_similarity, (0.5, 1.0), (0.0, 0.0, 3.0), blocking=F.lit("b")),
        L.MatchRule("x", F.col("x"), L.closeness(2000.0), (0.5,), (0.0, 1.0)),
    ]
    pairs, _ = L.compared(df, "id", rule)
    made = pairs.picked(lambda levels: (levels["name"] == 2) & (levels["x"] == 1))
    assert made.count() == 29_000
    links, _, _ = L.link_records(df, "id", rule, threshold=4.0)
    assert {r.right - r.left for r in links.collect()} == {1000}


def test_scores_without_a_block_form_take_single_pairs(spark):
    long_ = odd_records(spark).withColumn("name", F.concat(F.lit("x" * 70), "name"))
    with_lists = [*odd_rules()[:2], L.MatchRule("age", F.col("age"), L.closeness(10.0), (0.5,), blocking=F.array("place", "sex"))]
    own = [*odd_rules(), L.MatchRule("own", F.col("sex"), lambda a, b: (a == b).cast("double"))]
    for records, rule in ((long_, odd_rules()), (odd_records(spark), with_lists), (odd_records(spark), own)):
        pairs, _ = L.compared(records, "id", rule)
        assert not pairs.in_blocks()
        assert L.patterns(pairs, rule).agg(F.sum("pairs")).first()[0] == pairs.agg(F.sum("copies")).first()[0] > 0


def test_a_large_block_is_counted_without_a_row_for_each_pair(spark):
    """One block of 30,000 records: 450 million pairs."""
    n = 30_000
    name = F.concat(F.lit("Customer#"), F.lpad((F.col("id") % 500).cast("string"), 9, "0"))
    df = spark.range(n).select("id", name.alias("name"), (F.col("id") % 3).cast("string").alias("sex"), (F.col("id") * 1.0).alias("x"))
    rule = [
        L.MatchRule("name", F.col("name"), L.edit_similarity, (1.0,), blocking=F.lit("b")),
        L.MatchRule("sex", F.col("sex"), L.equal),
        L.MatchRule("x", F.col("x"), L.closeness(10.0), (0.5,)),
    ]
    pairs, _ = L.compared(df, "id", rule)
    counted = pairs.counted()
    assert counted.count() < 1000
    got = {(r.level_name, r.level_sex, r.level_x): r.pairs for r in L.patterns(pairs, rule).collect()}
    # Names come again every 500 records, the same sex every 3: both every 1,500.
    each = lambda step: sum(n - d for d in range(step, n, step))
    near = sum(n - d for d in range(1, 6))
    assert got == {
        (1, 1, 0): each(1500), (1, 0, 0): each(500) - each(1500), (0, 1, 0): each(3) - each(1500) - (n - 3),
        (0, 1, 1): n - 3, (0, 0, 1): near - (n - 3), (0, 0, 0): each(1) - each(3) - each(500) + each(1500) - near + n - 3,
    }


# --- vector cells ------------------------------------------------------------------


def clustered(spark, n=8000, dims=24, groups=80, seed=2):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, dims))
    x = middle[rng.integers(0, groups, n)] + 0.25 * rng.normal(size=(n, dims))
    rows = [(int(k), [float(v) for v in x[k]], f"g{k % 3}") for k in range(n)]
    odd = [(n, None, "g0"), (n + 1, [0.0] * dims, "g0"), (n + 2, [float("nan")] * dims, "g0"), (n + 3, [1.0], "g0"), (None, [1.0] * dims, "g0")]
    asks = [(k, [float(v) for v in x[k] + 0.1 * rng.normal(size=dims)], f"g{k % 3}") for k in range(0, n, 400)]
    schema = "vec_id long, embedding array<double>, label string"
    return spark.createDataFrame(rows + odd, schema), spark.createDataFrame(asks, schema.replace("vec_id", "question_id")), x, asks


@pytest.fixture(scope="module")
def planted_cells(spark):
    vectors, asks, x, raw = clustered(spark)
    return C.build_cells(vectors, "vec_id", "embedding", 24, cells=64, category="label", sample_rows=4000), asks, x, raw


def truth_of(x, raw, k, inside):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q, v, label in raw:
        s = unit @ (np.array(v) / np.linalg.norm(v))
        if inside:
            s = np.where([f"g{i % 3}" == label for i in range(len(x))], s, -2)
        out[q] = [int(i) for i in np.lexsort((np.arange(len(x)), -s))[:k]]
    return out


@pytest.mark.parametrize("inside", [False, True])
def test_few_cells_find_nearly_all(spark, planted_cells, inside):
    index, asks, x, raw = planted_cells
    want = truth_of(x, raw, 10, inside)
    label = "label" if inside else None
    got = {}
    for r in C.search_cells(index, asks, 10, probes=4, category=label).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append(r.vec_id)
    recall = np.mean([len({*got[q]} & {*want[q]}) / 10 for q in want])
    assert recall >= 0.95
    assert C.compared_share(index, asks, probes=4) <= 0.2
    exact = {}
    for r in C.search_cells(index, asks, 10, probes=1, category=label, exact=True).orderBy("question_id", "rank").collect():
        exact.setdefault(r.question_id, []).append(r.vec_id)
    assert exact == want


def test_cells_of_edges(spark, planted_cells):
    index, asks, x, _ = planted_cells
    assert int(index.rows.sum()) == len(x)
    empty = C.build_cells(spark.createDataFrame([], "vec_id long, embedding array<double>"), "vec_id", "embedding", 24)
    assert C.search_cells(empty, asks, 3, exact=True).count() == 0
    with pytest.raises(ValueError):
        C.search_cells(empty, asks, 3, category="label")
    none = asks.withColumn("embedding", F.lit(None).cast("array<double>"))
    assert C.search_cells(index, none, 3).count() == 0


def test_a_cell_of_equal_vectors_is_cut(spark, monkeypatch):
    monkeypatch.setattr(C, "PART_ROWS", 50)
    monkeypatch.setattr(C, "BLOCK_QUESTIONS", 4)
    rows = spark.range(400).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    index = C.build_cells(rows, "vec_id", "embedding", 2)
    asks = spark.range(20).select(F.col("id").alias("question_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    got = C.search_cells(index, asks, 3).collect()
    assert sorted((r.question_id, r.vec_id, r.rank) for r in got) == [(q, v, v + 1) for q in range(20) for v in range(3)]


def test_pairs_are_counted_without_being_stored(spark):
    """One block of 2,000 records: two million pairs, of which only a count is kept."""
    df = spark.range(2000).select("id", F.concat(F.lit("n"), F.col("id") % 50).alias("name"), F.lit("x").alias("b"))
    rule = [L.MatchRule("name", F.col("name"), L.edit_similarity, (1.0,), blocking=F.col("b")), L.MatchRule("id", F.col("id"), L.equal, blocking=F.array("b", F.col("name")))]
    pairs, _ = L.compared(df, "id", rule)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and plan.count("levenshtein(") == 1
    got = {(r.level_name, r.level_id): r.pairs for r in L.patterns(pairs, rule).collect()}
    same = 50 * (40 * 39 // 2)
    assert got == {(1, 0): same, (0, 0): 2000 * 1999 // 2 - same}
