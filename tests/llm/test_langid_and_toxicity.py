"""Language id and toxicity: held-out accuracy and defined results."""

import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tastegraph.llm import langid, toxicity

D = "/root/testdata/sf0.01"


def test_language_id_held_out(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_id_odd_rows(spark):
    rows = [(i, "the cat and the dog of house " * 3, "en", 1) for i in range(20)]
    rows += [(100 + i, "der hund und die katze das haus " * 3, "de", 1) for i in range(20)]
    rows += [(200, None, "en", 1), (201, "", "de", 1), (202, "123 !!", None, 1), (None, "und der", "de", 1), (203, "und die", None, 1),
             (203, "und die", None, 1), (204, "ü" * 200_000, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, turn int")
    got = langid.identify(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (200, 201, 202))
    assert by[203].lang_pred == "de" and by[5].lang_pred == "en" and by[None].lang_pred == "de"
    assert by[None].held_out is False
    nothing = langid.identify(df.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0


def test_presence_counts_shared_grams():
    a, b = set(langid.presence("abcd").tolist()), set(langid.presence("bcde").tolist())
    assert len(a) == 4 + 3 + 2 + 1 and len(a & b) == 3 + 2 + 1  # bcd, its parts
    assert len(langid.presence("")) == 0


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{D}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.train(docs, labels)


def test_toxicity_held_out(spark, model):
    docs, labels = (spark.read.parquet(f"{D}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score(docs, model).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    pos = [r.score for r in got if r.toxic]
    neg = [r.score for r in got if not r.toxic]
    better = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert better > 0.95
    assert all(r.predicted == int(r.score >= 0.7) for r in got)


def test_toxicity_odd_rows(spark, model):
    rows = [(1, None, "x", 1.0), (2, "", "x", 1.0), (3, "x" * 300_000, "x", 1.0), (None, "idiot loser trash moron", "x", 1.0)]
    df = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, whole string, score double")
    got = toxicity.score(df, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].score == by[2].score and by[None].held_out is False
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    plain = toxicity.score(df, toxicity.train(df, labels)).collect()
    assert {r.predicted for r in plain} == {0}
    docs = spark.read.parquet(f"{D}/documents.parquet").limit(0)
    assert toxicity.drop_toxic(docs, labels).count() == 0


def test_word_ratio_follows_the_counts(spark):
    rows = [(i, "good calm word text " * 5) for i in range(0, 60)] + [(i, "good vile word text " * 5) for i in range(100, 130)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in rows] + [(100, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    scorer = toxicity._Scorer(toxicity.train(df, labels))
    assert scorer["vile"] > 3 and scorer["calm"] < -3
    assert abs(scorer["good"]) < 1 and abs(scorer["zzzzz"]) < 1


def test_unseen_words_take_no_stranger_ratio(spark):
    rows = [(i, "good calm word text " * 5) for i in range(0, 60)] + [(i, "good vile word text " * 5) for i in range(100, 130)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in rows], "doc_id long, toxic int")
    scorer = toxicity._Scorer(toxicity.train(df, labels))
    taken = {zlib.crc32(g.encode()) % (1 << 21) for w in ("vile", "calm") for g in toxicity._grams(w)}
    words = ("".join(w) for w in itertools.product("bfhjknpqsuyz123456789", repeat=5))
    clash = list(itertools.islice((w for w in words if zlib.crc32(w.encode()) % (1 << 21) in taken), 3))
    assert len(clash) == 3
    assert [scorer[w] for w in clash] == pytest.approx([scorer["zzzzz"]] * 3)


def test_large_models_are_joined(spark, model, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    odd = [(None, "idiot loser trash moron"), (7, None), (8, " "), (9, "x" * 5000), (9, "x" * 5000), (10, "Ünïcode 😀😀 vile"), (11, "a a a b")]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    local = toxicity.train(docs, labels)
    monkeypatch.setattr(toxicity, "LOCAL_KEYS", 0)
    joined = toxicity.train(docs, labels)
    assert not isinstance(joined.grams, type(local.grams))
    assert joined.weights == pytest.approx(local.weights, rel=1e-6)
    a, b = (sorted(((r.doc_id or -1, r.score) for r in toxicity.score(rows, m).collect())) for m in (local, joined))
    assert [i for i, _ in a] == [i for i, _ in b]
    assert [x for _, x in a] == pytest.approx([x for _, x in b], abs=1e-6)


def test_language_id_equals_kernel_ridge_on_sets(spark):
    """Kernel, Nystroem map and ridge regression recomputed from sets of n-grams."""
    words = {"en": "the cat and dog of house with", "de": "der hund und die katze das haus mit", "fr": "le chat et la maison avec un"}
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(w.split(), 8)), k) for i, (k, w) in enumerate(list(words.items()) * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    grams = lambda t: frozenset(langid.presence(t).tolist())
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    taught = [(k, grams(t)) for i, t, k in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    bits = lambda s: bytes(np.packbits(np.isin(np.arange(1 << langid.BITS), list(s))))
    turns, order = Counter(), []
    for k, s in sorted(taught, key=lambda r: (r[0], bits(r[1]))):
        order.append((turns[k], k, s))
        turns[k] += 1
    taught = [(k, s) for _, k, s in sorted(order, key=lambda r: r[:2])]
    marks = [s for _, s in taught[: langid.LANDMARKS]]
    kzz = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(kzz)
    ok = values > 1e-6 * values.max()
    root = vectors[:, ok] / np.sqrt(values[ok])
    phi = np.array([[kernel(s, z) for z in marks] for _, s in taught]) @ root
    kinds = sorted(words)
    y = np.array([[1.0 if k == kind else -1.0 for kind in kinds] for k, _ in taught])
    beta = np.linalg.solve(phi.T @ phi + langid.RIDGE * len(taught) * np.eye(phi.shape[1]), phi.T @ (y - y.mean(0)))
    for i, t, _ in rows:
        score = np.array([kernel(grams(t), z) for z in marks]) @ root @ beta + y.mean(0)
        assert got[i].lang_pred == kinds[int(score.argmax())]
        assert got[i].score == pytest.approx(min(1, max(0, (score.max() + 1) / 2)), abs=2e-3)


def test_the_sample_is_bounded_in_rows(spark, monkeypatch):
    rows = [(1, f"the cat and dog {i}", "en") for i in range(400)] + [(4, "der hund und die katze", "de")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen, fit = [], langid.fit
    monkeypatch.setattr(langid, "fit", lambda bits, langs: seen.append(Counter(langs)) or fit(bits, langs))
    assert langid.identify(df, per_language=20, sample_rows=30).count() == 700
    assert all(n <= 20 for n in seen[0].values()) and sum(seen[0].values()) <= 30


def kneser_ney(plain, toxic):
    """log(p_toxic / p_plain) of a word, by the textbook recursion over all counts."""
    d, counts = toxicity.DISCOUNT, {5: defaultdict(lambda: [0, 0])}
    for cls, texts in enumerate((plain, toxic)):
        for w in " ".join(texts).lower().split():
            for g in toxicity._grams(w):
                counts[5][g][cls] += 1
    for n in (5, 4):
        counts[n - 1] = defaultdict(lambda: [0, 0])
        for g, c in counts[n].items():
            for cls in (0, 1):
                counts[n - 1][g[1:]][cls] += c[cls] > 0
    both = {3: Counter(list(counts[3]))}
    for n in (3, 2):
        both[n - 1] = Counter(g[1:] for g in both[n])

    def shared(g):
        if len(g) == 1:
            return (both[1][g] + 1) / (sum(both[1].values()) + len(both[1]) + 1)
        follow = [c for h, c in both[2].items() if h[0] == g[0]]
        return max(both[2][g] - d, 0) / sum(follow) + d * len(follow) / sum(follow) * shared(g[1:])

    def rest(ctx, cls):
        follow = [c[cls] for h, c in counts[len(ctx) + 1].items() if h[:-1] == ctx and c[cls]]
        return (sum(follow), d * len(follow) / sum(follow)) if follow else (0, 1.0)

    def p(g, cls):
        if len(g) == toxicity.SHARED:
            return shared(g)
        n, left = rest(g[:-1], cls)
        return (max(counts[len(g)][g][cls] - d, 0) / n if n else 0.0) + left * p(g[1:], cls)

    def ratio(g):
        if len(g) == toxicity.SHARED:
            return 0.0
        if g in counts[len(g)]:
            return math.log(p(g, 1) / p(g, 0))
        return math.log(rest(g[:-1], 1)[1] / rest(g[:-1], 0)[1]) + ratio(g[1:])

    return lambda word: sum(map(ratio, toxicity._grams(word)))


def test_word_ratios_equal_kneser_ney_by_hand(spark):
    rng = np.random.default_rng(7)
    plain = [" ".join(rng.choice("good calm word text hello there worded".split(), 6)) for _ in range(40)]
    toxic = [" ".join(rng.choice("vile word trash texts there mean wording".split(), 6)) for _ in range(25)]
    rows = list(enumerate(plain)) + [(1000 + i, t) for i, t in enumerate(toxic)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in rows], "doc_id long, toxic int")
    learned = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    truth = kneser_ney([t for i, t in learned if i < 1000], [t for i, t in learned if i >= 1000])
    scorer = toxicity._Scorer(toxicity.train(df, labels))
    for w in "good calm word text vile trash wording unseen zzz words vi textile thermal é".split():
        assert scorer[w] == pytest.approx(truth(w), abs=1e-9), w


def test_packed_ratios_equal_a_dictionary(monkeypatch):
    """tables are looked up packed, whatever the alphabet, and well beyond a million keys."""
    assert toxicity.LOCAL_KEYS > 4_000_000
    rng = np.random.default_rng(5)
    letters = list("ab\0é中\U0001f600\U0010ffff") + [chr(c) for c in range(0x4E00, 0x4E00 + 6000, 200)]
    taught = ["".join(rng.choice(letters, rng.integers(1, 7))) for _ in range(400)]
    grams, contexts = {}, {}
    for g in {g for w in taught for g in toxicity._grams(w)}:
        for n in range(5, 2, -1):
            grams[g[-n:]], contexts[g[-n:][:-1]] = rng.normal(), rng.normal()
    tables = [pa.table({"key": pa.array(list(t), pa.string()), "r": pa.array(list(t.values()), pa.float64())}) for t in (grams, contexts)]
    monkeypatch.setattr(toxicity, "WINDOWS", 100)
    monkeypatch.setattr(toxicity, "MEMO", 50)
    scorer = toxicity._Scorer(toxicity.Model(*toxicity.packed(*tables), np.zeros(3)))

    def ratio(g):
        return 0.0 if len(g) == toxicity.SHARED else grams[g] if g in grams else contexts.get(g[:-1], 0.0) + ratio(g[1:])

    words = taught[:60] + ["".join(rng.choice([*letters, "z", "ß"], rng.integers(1, 9))) for _ in range(300)]
    for i in range(0, len(words), 9):
        part = words[i : i + 9]
        want = [sum(map(ratio, toxicity._grams(w))) for w in part]
        assert scorer._ratios(part) == pytest.approx(want, abs=1e-9)
        assert [scorer[w] for w in part] == pytest.approx(want, abs=1e-9)
    text = " ".join(words[:40])
    n, low = 40, [w.lower() for w in words[:40]]
    rs = [sum(map(ratio, toxicity._grams(w))) for w in low]
    whole, telling = scorer.evidences([None, text, " "])[1]
    assert whole == pytest.approx(sum(rs) / (sum(map(len, low)) + n)) and scorer.evidences([None, " "]) == [(0.0, 0.0)] * 2
    assert telling == pytest.approx(sum(min(r, toxicity.MOST) for r in sorted(rs)[-toxicity.TELLING :]) / toxicity.TELLING)
