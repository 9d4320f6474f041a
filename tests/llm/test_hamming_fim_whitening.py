"""Multi-index near dedup, fill-in-middle and whitening against brute force, round trips and numpy."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegraph.llm import fim, hamming, whitening

DOCS = "doc_id long, text string"
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


# --- near dedup ------------------------------------------------------------------------
def shingles(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset([tuple(words)] if words else [])


def near_truth(rows):
    """[(doc_id, n_shingles, component_id, kept)] by comparing every two sets."""
    sets = {}
    for i, t in rows:
        if i is not None and shingles(t):
            sets[shingles(t)] = min(i, sets.get(shingles(t), i))
    keys = list(sets)
    root = list(range(len(keys)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(keys)):
        for b in range(a):
            both = len(keys[a] & keys[b])
            if 100 * both >= 80 * (len(keys[a]) + len(keys[b]) - both):
                root[top(a)] = top(b)
    low = {}
    for a, k in enumerate(keys):
        low[top(a)] = min(sets[k], low.get(top(a), sets[k]))
    out = []
    for i, t in rows:
        s = shingles(t)
        c = None if i is None else low[top(keys.index(s))] if s else i
        out.append((i, len(s), c, i is None or i == c))
    return sorted(out, key=str)


def near(spark, rows):
    got = hamming.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    return sorted(map(tuple, got), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(2000)}"
    out, base = [], [[word() for _ in range(rng.randrange(40, 160))] for _ in range(10)]
    for b in base:
        out += [" ".join(b), "  " + "\n".join(b).upper()]
        for k in (1, 2, 4, 8):
            w = list(b)
            for _ in range(k):
                w[rng.randrange(len(w))] = word()
            out.append(" ".join(w))
    chain = [word() for _ in range(120)]  # each text near the next, the ends far apart
    for _ in range(12):
        out.append(" ".join(chain))
        for _ in range(5):
            chain[rng.randrange(len(chain))] = word()
    passage = [word() for _ in range(60)]  # shared, but not near
    out += [" ".join([word() for _ in range(60)] + passage) for _ in range(10)]
    out += [None, "", " \n ", "one", "ONE", "two words", "Two Words", "two  words three", "É é", "é é", "x " * 500]
    rng.shuffle(out)
    return [(i * 5 + 2, t) for i, t in enumerate(out)]


def test_components_equal_brute_force(spark, corpus):
    assert near(spark, corpus) == near_truth(corpus)


def test_small_blocks_find_the_same(spark, corpus, monkeypatch):
    monkeypatch.setattr(hamming, "BLOCK", 3)
    assert near(spark, corpus) == near_truth(corpus)


def test_repeated_ids_and_rows_are_judged_by_their_text(spark):
    rng = random.Random(4)
    a, b = (" ".join(f"v{rng.randrange(500)}" for _ in range(50)) for _ in range(2))
    rows = [(7, a), (7, b), (7, b), (3, b + " end"), (7, None), (None, a), (None, None), (9, a)]
    assert near(spark, rows) == near_truth(rows)


def test_near_dedup_of_other_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "x")], "doc_id int, text string, component_id int, digest string")
    assert [tuple(r) for r in hamming.near_duplicates(docs).collect()] == [(1, 2, 1, True)]
    assert near(spark, []) == []


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(2)
    distance = hamming.distance_for()
    plan = hamming.chunk_plan(hamming.POSITIONS, distance)
    assert sum(e + 1 for _, _, e in plan) > distance
    assert [p for s, e, _ in plan for p in range(s, e)] == list(range(hamming.POSITIONS))
    for _ in range(300):
        a = rng.integers(0, 2**hamming.BITS, hamming.POSITIONS).astype(np.uint16)
        b = a.copy()
        b[rng.choice(hamming.POSITIONS, distance, replace=False)] ^= np.uint16(1)
        keys = hamming.signature_keys(np.stack([a, b]), plan)
        assert (keys[0] == keys[1]).any()
    two = hamming.chunk_plan(12, 5, errors=2)
    assert two == [(0, 6, 2), (6, 12, 2)]


def test_distance_threshold_keeps_the_recall():
    assert hamming.distance_for(0.999) == 28
    rng, family, far = np.random.default_rng(5), hamming._family(hamming.POSITIONS), 0
    for _ in range(300):  # Jaccard 0.8: 80 of 100
        s = rng.integers(0, 2**63, 100, np.uint64)
        a, b = (hamming.signature(np.sort(x), family) for x in (s[:90], s[10:]))
        far += int((a != b).sum()) > 28
    assert far <= 3


# --- fill-in-middle --------------------------------------------------------------------
def fim_truth(i, t, unit="token"):
    t = t or ""
    u = re.findall(f"{BLANK}*{WORD}|{BLANK}+", t) if unit == "token" else list(t)
    h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(u)
    if not t or h3 % 100 >= 50 or any(s in t for s in ("<P>", "<S>", "<M>")):
        return i, n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < 80:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_rows():
    rng = random.Random(1)
    letters = ["a", "b", " ", "\n", "é", "ß", "中", "😀", "́", " ", " ", "<", "P", "S", ">", "<P", "<S"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 60))) for _ in range(400)]
    texts += [None, "", " ", "\t\n ", "one", " one ", "<P>", "a <M> b", "<<S>S>", "中" * 3000, "word " * 40_000]
    return [(i * 7, t) for i, t in enumerate(texts)] + [(7, "again"), (7, "again"), (None, "no id here"), (None, None)]


@pytest.mark.parametrize("unit", ["token", "char"])
def test_fim_equals_slices_of_the_text(spark, unit):
    rows = fim_rows()
    got = fim.restore(fim.fill_in_middle(spark.createDataFrame(rows, DOCS), unit)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted((fim_truth(i, t, unit) for i, t in rows), key=key)
    assert sorted((str(r.doc_id), r.restored) for r in got) == sorted((str(i), t or "") for i, t in rows)
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_exception_index_converts_both_ways():
    text = "aé中😀b́" * 5
    index = fim.ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
    assert len(index.starts) == 20 and index.n_chars == len(text)
    for n in range(len(text) + 1):
        at = len(text[:n].encode())
        assert index.byte_of(n) == at and index.chars_before(at) == n


def test_fim_of_other_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "q", 3)], "doc_id int, text string, output string, n int")
    row = fim.digests(fim.fill_in_middle(docs)).first()
    assert row.restored_sha256 == hashlib.sha256(b"a b").hexdigest() and row.n == 2
    assert fim.fill_in_middle(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, unit="line")


# --- whitening -------------------------------------------------------------------------
VECS = "vec_id long, embedding array<double>"


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((700, 20)) * np.r_[5, 5, 4.999, np.linspace(2, 0.1, 17)] + 3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(1000, None), (1001, []), (1002, [1.0] * 19 + [None]), (1003, [1.0] * 19 + [float("nan")]), (1004, [1.0] * 19 + [float("inf")]), (1005, [2.0] * 7)]
    df = spark.createDataFrame(rows + bad, VECS).repartition(3)
    fitted = whitening.fit(df)
    q = np.floor(x * 1024).astype(np.int64) + 100000
    c = q - q.mean(0)
    v = c.T @ c / len(c)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    assert np.allclose(fitted.values, e, rtol=1e-13)
    assert np.linalg.norm(v @ fitted.vectors - fitted.vectors * fitted.values, axis=0).max() <= 1e-13 * e[0]
    assert fitted.residuals.max() <= 1e-13 * e[0]
    got = whitening.whiten(df, fitted).toPandas()
    assert len(got) == 700 * 8 and set(got["n"]) == {700} and got["vec_id"].max() == 699
    sums = q.sum(0)
    want = ((700 * q - sums) ** 2).sum(1)
    for j, part in got.groupby("component"):
        part = part.sort_values("vec_id")
        assert (part["deviation"].to_numpy() == want).all()
        assert np.allclose(part["whitened"], c @ fitted.vectors[:, j - 1] / np.sqrt(e[j - 1]), atol=1e-9)
        assert np.allclose(part["explained"], e[j - 1] / np.trace(v))
    w = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(w.T @ w / 700 - np.eye(8)).max() < 1e-10 and got["identity_error"].max() < 1e-10


@pytest.mark.parametrize("dim", [5, 120, 600])
def test_jacobi_davidson_on_close_and_multiple_values(dim):
    rng = np.random.default_rng(dim)
    turn, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    e = np.sort(np.r_[rng.uniform(0, 10, dim - 5), 12, 12, 11.9999, 11, 10.5])[::-1]
    v = (turn * e) @ turn.T
    v, calls = (v + v.T) / 2, []

    def product(t):
        calls.append(t.shape[1])
        return v @ t

    values, vectors, residuals = whitening.jacobi_davidson(product, dim, 8, max_basis=60)
    k = min(8, dim)
    assert np.allclose(values, e[:k], rtol=1e-13) and vectors.shape == (dim, k)
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() <= 1e-11 * e[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert max(calls) <= 24 and residuals.max() < 1e-11 * e[0]


def test_minres_solves_the_correction_equation():
    rng = np.random.default_rng(8)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    u, _ = np.linalg.qr(rng.standard_normal((30, 3)))
    r = rng.standard_normal((30, 2))
    shift = np.array([3.0, -2.0])
    t = whitening.minres(lambda m: a @ m, shift, u, r, 60, 1e-13)
    p = np.eye(30) - u @ u.T
    for j in range(2):
        assert np.linalg.norm(p @ (a - shift[j] * np.eye(30)) @ p @ t[:, j] + p @ r[:, j]) < 1e-8


def test_deviations_are_exact_beyond_doubles_and_null_beyond_longs():
    x = np.array([[2**40, 5], [3, 2**39], [0, 0]], np.int64)
    centre = whitening.Centre(3, x.sum(0))
    want = [sum((3 * int(a) - int(s)) ** 2 for a, s in zip(row, x.sum(0))) for row in x]
    assert max(want) > 2**63 and centre.deviation(x) == [d if d < 2**63 else None for d in want]
    x = np.array([[2**30, 5], [3, 2**29]], np.int64)
    want = [sum((2 * int(a) - int(s)) ** 2 for a, s in zip(row, x.sum(0))) for row in x]
    assert max(want) > 2**53 and whitening.Centre(2, x.sum(0)).deviation(x) == want


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None), (2, [])]])
def test_vectors_without_variance_give_no_rows(spark, rows):
    df = spark.createDataFrame(rows, VECS)
    out = whitening.whiten(df, whitening.fit(df))
    assert out.collect() == [] and out.columns[:5] == ["vec_id", "component", "n", "deviation", "whitened"]


def test_fewer_dimensions_repeated_ids_and_other_columns(spark):
    rows = [(1, [0.0, 1.0, 1.0], 5), (1, [2.0, 1.0, 1.0], 6), (None, [5.0, 1.0, 1.0], 7), (2, [0.0, 1.0, 1.0], 8), (2, [0.0], 8)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>, n int")
    got = whitening.whiten(df, whitening.fit(df)).orderBy(F.col("vec_id").asc_nulls_last(), "deviation").collect()
    assert [(r.vec_id, r.component, r.n) for r in got] == [(1, 1, 4), (1, 1, 4), (2, 1, 4), (None, 1, 4)]
    assert all(abs(r.explained - 1) < 1e-12 for r in got)


def test_few_open_nodes_of_a_large_bucket_are_sent_once(spark):
    members = spark.range(2000).select(F.lit(1).cast("long").alias("key"), F.col("id").alias("node"))
    labels = spark.range(1900).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("label"))
    cells = hamming._cells(members, labels).groupBy("side").count().collect()
    assert dict(tuple(r) for r in cells) == {0: 100, 1: 2000}  # asked nodes: 400 copies before
