"""Exact searches that skip work: prefix index, cluster-pruned dense cosine, norm-ordered inner products, ALS proofs, term hashes."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from tastegraph.functions.scalar import murmur3
from tastegraph.operators import content, factors, innerproduct, similarity, topk, tuning
from tastegraph.sources import tables


# --- sparse cosine above a threshold ------------------------------------------------
def postings(rng, n, vocabulary, repeat=0):
    """Zipf-like vectors, some equal, some with a zero weight."""
    vectors = []
    for _ in range(n):
        terms = {min(vocabulary - 1, int(rng.paretovariate(0.6)) - 1) for _ in range(rng.randrange(1, 14))}
        vectors.append({t: rng.choice([0.0, 0.5, 1.0, 2.5]) * math.log(2 + t) for t in terms})
    vectors += [dict(rng.choice(vectors)) for _ in range(repeat)]
    return {i * 3 + 1: v for i, v in enumerate(vectors)}


def sparse_truth(vectors, threshold):
    out = {}
    for a, x in vectors.items():
        for b, y in vectors.items():
            nx, ny = (math.sqrt(sum(w * w for w in v.values())) for v in (x, y))
            if a != b and nx and ny:
                s = sum(w * y.get(t, 0.0) for t, w in x.items()) / nx / ny
                if s > threshold:
                    out[a, b] = s
    return out


@pytest.mark.parametrize("threshold,pairs_per_task", [(0.4, 2_000_000), (0.75, 60), (0.0, 500)])
def test_sparse_cosine_equals_all_pairs(spark, threshold, pairs_per_task, monkeypatch):
    monkeypatch.setattr(similarity, "MOST_PAIRS", 50)
    vectors = postings(random.Random(5), 120, 40, repeat=25)
    rows = [(f"t{t}", i, w) for i, v in vectors.items() for t, w in v.items()]
    df = spark.createDataFrame(rows, "term string, productId int, w double")
    got = {(r.productId, r.otherId): r.sim for r in similarity.sparse_cosine(df, threshold, pairs_per_task).collect()}
    want = sparse_truth(vectors, threshold)
    near = {p for p, s in want.items() if abs(s - threshold) < 1e-9}
    assert set(got) - near == set(want) - near and len(want) > 100
    assert all(math.isclose(got[p], want[p], rel_tol=1e-9) for p in got if p in want)


def test_prefix_index_leaves_frequent_terms_out(spark):
    rows = [(t, i, 1.0) for i in range(60) for t in ["everywhere", f"rare{i // 2}", f"own{i}", f"also{i // 2}"]]
    vectors = spark.createDataFrame(rows, "term string, vid int, w double")
    index = similarity.prefix_index(vectors, 0.55).persist()
    assert index.where("not indexed").select("tid").distinct().count() == 1  # the term of every vector
    candidates = {tuple(r) for r in similarity.candidate_pairs(index, 0.55).collect()}
    assert candidates == {(i, i + 1) for i in range(0, 60, 2)}


def test_equal_vectors_share_one_id(spark):
    rows = [("a", 4, 1.0), ("b", 4, 2.0), ("b", 9, 2.0), ("a", 9, 1.0), ("a", 5, 1.0), ("b", 5, 2.5), ("a", 7, 0.0)]
    members, reps = similarity.distinct_vectors(spark.createDataFrame(rows, "term string, productId int, w double"))
    assert {tuple(r) for r in members.collect()} == {(4, 4), (9, 4), (5, 5)}
    assert sorted(map(tuple, reps.collect())) == [("a", 4, 1.0), ("a", 5, 1.0), ("b", 4, 2.0), ("b", 5, 2.5)]


def test_sparse_cosine_of_nothing(spark):
    empty = spark.createDataFrame([], "term string, productId int, w double")
    assert similarity.sparse_cosine(empty, 0.4).count() == 0
    with pytest.raises(ValueError):
        similarity.sparse_cosine(empty, -0.5)


def test_hashed_terms_are_those_of_hashing_tf(spark):
    words = ["", "a", "ab", "abc", "abcd", "abcde", "é", "中文字", "😀", "naïve-words", "x" * 1000, " blank "]
    words += [r.w for r in tables.products(spark, SF_SMALL).select(F.explode(F.split("tags", "[| ]")).alias("w")).distinct().collect()]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.b for r in df.select("w", F.pmod(murmur3("w"), F.lit(content.HASH_BUCKETS)).alias("b")).collect()}
    tf = HashingTF(numFeatures=content.HASH_BUCKETS, inputCol="w", outputCol="f")
    assert got == {w: tf.indexOf(w) for w in words}


# --- dense cosine --------------------------------------------------------------------
def clustered(n=900, dim=16, centres=9):
    rng = np.random.default_rng(3)
    c = rng.standard_normal((centres, dim))
    return c[rng.integers(0, centres, n)] * 4 + rng.standard_normal((n, dim)) * 0.3


def test_dense_blocks_too_far_apart_are_skipped(spark):
    x = clustered()
    x[7] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    plan, _ = similarity.dense_plan(df.where("id <> 7"), 0.8, 40)
    assert plan.skipped > 0.4
    edges = similarity.dense_cosine_topk(df, 5, 0.8, block_rows=40)
    got = {(r.productId, r["rank"]): r.otherId for r in topk.rank_per_key(edges, "productId", "sim", "otherId", 5).collect()}
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    sims = unit @ unit.T
    want = {}
    for i in range(len(x)):
        near = sorted((-innerproduct.score_keys(sims[i, j]), j) for j in np.flatnonzero(sims[i] > 0.8) if j != i)
        want |= {(i, k + 1): j for k, (_, j) in enumerate(near[:5])}
    assert got == want and len(want) > 3000


@pytest.mark.parametrize("dim,threshold,cell_rows", [(5, 0.4, 60), (16, 0.4, 25), (5, None, 4000)])
def test_dense_queries_and_targets_meet_in_cells(spark, dim, threshold, cell_rows):
    rng = np.random.default_rng(dim)
    x = rng.standard_normal((700, dim))
    x[:40] = x[40:80]  # ties at the cut
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, vec array<double>")
    edges = similarity.dense_cosine_topk(df, 6, threshold, block_rows=50, cell_rows=cell_rows)
    got = {(r.productId, r["rank"]): r.otherId for r in topk.rank_per_key(edges, "productId", "sim", "otherId", 6).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = unit @ unit.T
    want = {}
    for i in range(len(x)):
        near = sorted((-innerproduct.score_keys(sims[i, j]), j) for j in range(len(x)) if j != i and (threshold is None or sims[i, j] > threshold))
        want |= {(i, n + 1): j for n, (_, j) in enumerate(near[:6])}
    assert got == want and len(want) > 3000


def test_dense_queries_are_sent_to_few_blocks(spark):
    """In few dimensions the k-th best of the own block keeps a vector from nearly all other blocks, whatever the threshold."""
    x = np.random.default_rng(1).standard_normal((6000, 5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, vec array<double>")
    sent = []
    keep = similarity._sent

    def spy(*args):
        out = keep(*args)
        if args[-1] is None:
            sent.append((out.agg(F.sum("n")).first()[0], len(args[3][2])))
        return out

    similarity._sent = spy
    try:
        similarity.dense_cosine_topk(df, 5, 0.4, block_rows=100, cell_rows=100)
    finally:
        similarity._sent = keep
    (copies, blocks), = sent
    assert blocks > 50 and copies < 0.35 * len(x) * blocks


def test_dense_plan_skips_nothing_without_a_threshold(spark):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(clustered(200))], "id int, vec array<double>")
    assert similarity.dense_plan(df, None, 30)[0].skipped == 0
    assert similarity.dense_cosine_topk(df.limit(0), 3).count() == 0


def test_blocks_keep_ties_by_the_ranking_rule():
    sims = np.array([[0.5000004999995, 0.5000005000001, 0.5, 0.49]])  # millionths 500000 or 500001 by the rule's half
    got = similarity._rows_topk(sims, np.array([1]), np.array([9, 8, 7, 6]), 1, None, same=False)
    best = innerproduct.score_keys(sims[0])
    assert set(got["otherId"]) == {i for i, s in zip([9, 8, 7, 6], best) if s == best.max()}


# --- inner products and ALS ----------------------------------------------------------
def inner_truth(users, items, k, exclude=()):
    out = {}
    for u, x in users.items():
        best = [(-innerproduct.score_keys(np.dot(x, y)), i) for i, y in items.items() if np.dot(x, y) > 0 and (u, i) not in exclude]
        out[u] = [i for _, i in sorted(best)[:k]]
    return out


@pytest.mark.parametrize("first_round", [16, 4096])
def test_top_inner_products_equal_brute_force(spark, first_round, monkeypatch):
    monkeypatch.setattr(innerproduct, "FIRST_ROUND", first_round)
    rng = np.random.default_rng(6)
    users = {i: rng.standard_normal(4) for i in range(0, 120, 2)} | {999: np.zeros(4)}
    items = {i: rng.standard_normal(4) * rng.lognormal(0, 1.5) for i in range(300)}
    items |= {400 + i: items[5] for i in range(6)}  # ties: the smaller id wins
    items[600] = np.zeros(4)
    exclude = {(u, i) for u in users for i in rng.choice(300, 60, replace=False).tolist()} | {(0, i) for i in items}
    frame = lambda d: spark.createDataFrame([(i, v.tolist()) for i, v in d.items()], "id int, vec array<float>")
    single = lambda d: {i: v.astype(np.float32).astype(float) for i, v in d.items()}
    for left_out in (set(), exclude):
        seen = spark.createDataFrame(sorted(left_out), "id int, other int") if left_out else None
        best = innerproduct.top_inner_products(frame(users), frame(items), 7, seen, block_rows=32)
        got = {}
        for r in topk.rank_per_key(best, "id", "score", "other", 7).orderBy("rank").collect():
            got.setdefault(r.id, []).append(r.other)
        want = inner_truth(single(users), single(items), 7, left_out)
        assert got == {u: w for u, w in want.items() if w}
    assert innerproduct.top_inner_products(frame(users), frame(items).limit(0), 3).count() == 0


def test_a_block_of_users_is_scored_in_slices(spark, monkeypatch):
    """Blocks are large so that few copies move; a cell holds the scores of a slice of its users at once."""
    rng = np.random.default_rng(8)
    users, items = ({i: rng.standard_normal(3) for i in range(n)} for n in (90, 40))
    monkeypatch.setattr(innerproduct, "SLICE_ENTRIES", 300)
    cell = innerproduct._cell(5)
    frame = lambda d: pd.DataFrame({"id": list(d), "vec": list(d.values())})
    out = {(3, 7), (89, 0), (89, 39)}
    left_out = pd.DataFrame({"id": [i for _, i in out], "vec": None, "user": [float(u) for u, _ in out]})
    right = pd.concat([frame(items).assign(user=np.nan), left_out], ignore_index=True)
    largest = []
    monkeypatch.setattr(innerproduct, "score_keys", lambda x, f=innerproduct.score_keys: largest.append(x.size) or f(x))
    got = cell(None, frame(users).assign(reached=np.nan), right)
    ranked = got.sort_values(["score"], ascending=False).groupby("id")["other"].apply(lambda x: x.tolist()[:5]).to_dict()
    assert ranked == {u: w for u, w in inner_truth(users, items, 5, out).items() if w}
    assert max(largest) <= 300 and innerproduct.BLOCK_ROWS > innerproduct.FIRST_ROUND


def test_rounds_grow_and_end():
    sizes = [(c, 1000, 2.0**-c) for c in range(40)]
    rounds = innerproduct._rounds(sizes)
    assert [r[0] for r in rounds][0] == 0 and rounds[-1][1] == 39 and sum(r[2] for r in rounds) == 40_000
    assert all(a[1] + 1 == b[0] for a, b in zip(rounds, rounds[1:])) and len(rounds) < 5


def test_als_lists_are_those_of_the_factors(spark):
    ratings = tables.ratings(spark, SF_SMALL).persist()
    model = factors.fit_als(ratings)
    side = lambda f: {r.id: np.array(r.features, float) for r in f.collect()}
    users, items = side(model.userFactors), side(model.itemFactors)
    seen = {tuple(r) for r in ratings.select("userId", "productId").distinct().collect()}
    for exclude in (set(), seen):
        got = {}
        for r in factors.user_recs(model, 20, ratings if exclude else None).orderBy("rank").collect():
            got.setdefault(r.userId, []).append(r.productId)
        assert got == {u: w for u, w in inner_truth(users, items, 20, exclude).items() if w}


def test_residuals_are_those_of_the_normal_equations(spark):
    ratings = tables.ratings(spark, SF_SMALL).persist()
    model = factors.fit_als(ratings)
    rows = [tuple(r) for r in ratings.select("userId", "productId", "score").collect()]
    u, v = ({r.id: np.array(r.features, float) for r in f.collect()} for f in (model.userFactors, model.itemFactors))
    got = {(r.kind, r.id): (r.n, r.residual) for r in factors.normal_residuals(model, ratings).collect()}
    assert len(got) == len(u) + len(v)
    for kind, own, other, at in (("user", u, v, 0), ("product", v, u, 1)):
        for i in list(own)[:40]:
            mine = [(other[r[1 - at]], r[2]) for r in rows if r[at] == i]
            left = sum(y * (y @ own[i] - s) for y, s in mine) + factors.ALS_REG * len(mine) * own[i]
            want = np.linalg.norm(left) / np.linalg.norm(sum(s * y for y, s in mine))
            assert got[kind, i][0] == len(mine) and math.isclose(got[kind, i][1], want, rel_tol=1e-6, abs_tol=1e-9)
    assert max(r for (k, _), (_, r) in got.items() if k == "user") < factors.USER_RESIDUAL


def test_a_wrong_factor_shows_in_its_residual(spark):
    ratings = tables.ratings(spark, SF_SMALL).persist()
    short = factors.normal_residuals(factors.fit_als(ratings, max_iter=1), ratings)
    assert short.where("kind = 'product'").agg(F.max("residual")).first()[0] > factors.PRODUCT_RESIDUAL


def test_grid_flags_the_best_of_its_table(spark):
    rows = tuning.als_grid(tables.ratings(spark, SF_SMALL), ranks=(2, 3), lambdas=(0.1, 0.01), max_iter=2).collect()
    best = [r for r in rows if r.best]
    assert len(rows) == 4 and len(best) == 1 and best[0].rmse == min(r.rmse for r in rows)


def test_residuals_sum_where_rows_lie(spark):
    """sums of single ratings are not shuffled; the own side's factors come last."""
    ratings = spark.createDataFrame([(u, (u * 3 + j) % 7, 3.0, 0) for u in range(8) for j in range(4)], "userId int, productId int, score double, timestamp long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = factors.normal_residuals(factors.fit_als(ratings, max_iter=1), ratings)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    assert not [x for x, y in zip(lines, lines[1:]) if "Exchange" in x and "Aggregate" in y and "partial_sum" in y]


def test_many_pairs_of_long_vectors_meet_in_few_cells():
    """A cell's vectors are bounded by its pairs or by its row and column, whichever is less."""
    cells, most = similarity.CELL_ENTRIES, similarity.MOST_PAIRS
    for pairs, vectors, entries in ((2_636_586, 9_295, 2_505_791), (68_000_000, 48_000, 13_000_000), (500, 10**6, 10**9), (10**9, 10**6, 10**7)):
        side = similarity.verifying_side(pairs, vectors, entries)
        held = entries / vectors * min(2 * pairs / side**2, 2 * vectors / side)
        assert pairs / side**2 <= most and held <= cells * (1 + 1e-9)
    assert similarity.verifying_side(2_636_586, 9_295, 2_505_791) <= 7  # 27 if every pair counted two vectors
