"""Jaccard join, substring dedup and line dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegraph.llm import jaccard, linededup, substrings

SMALL = "/root/testdata/sf0.001/documents.parquet"


def made_up(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, repeats inside a text, junk and edge cases."""
    rng = random.Random(3)
    out, base = [], [made_up(rng, rng.randrange(60, 200)) for _ in range(12)]
    for b in base:
        out.append(" ".join(b))
        out.append("  " + "\n".join(b))  # same words, other spaces
        for k in (1, 2, 6):
            w = list(b)
            for _ in range(k):
                w[rng.randrange(len(w))] = "changed"
            out.append(" ".join(w))
    passage = made_up(rng, 55)
    for _ in range(8):
        out.append(" ".join(made_up(rng, 40) + passage + made_up(rng, 30)))
    out += [" ".join(passage[:19]), " ".join(passage[:20]), " ".join(passage * 2), "same " * 90, "a b c d", "a b c d", "one"]
    out += [None, "", " \n ", "é" * 50]
    rng.shuffle(out)
    return [(i * 3 + 1, t) for i, t in enumerate(out)]


def words(t):
    return tuple((t or "").encode().split())


def near_truth(rows):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = (w, frozenset(w[a : a + 5] for a in range(max(1, len(w) - 4))) if w else frozenset())
    rep = {}
    for i, (w, _) in sorted(sets.items()):
        if w:
            rep.setdefault(w, i)
    links, root = Counter(), {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    heads = sorted(rep.values())
    for x, a in enumerate(heads):
        for b in heads[:x]:
            s, t = sets[a][1], sets[b][1]
            if 5 * len(s & t) >= 4 * len(s | t):
                links[a] += 1
                links[b] += 1
                root[max(top(a), top(b))] = min(top(a), top(b))
    copies = Counter(w for w, _ in sets.values() if w)
    return {i: (top(rep.get(w, i)), links[rep.get(w, i)], copies[w] - 1 if w else 0) for i, (w, _) in sets.items()}


def near_found(spark, rows):
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, class_id string")
    return jaccard.near_duplicates(df)


@pytest.mark.parametrize("block", [512, 2])
def test_jaccard_join(spark, corpus, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)  # 2: every bucket of three meets in pairs of blocks
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in near_found(spark, corpus).collect()}
    assert got == near_truth(corpus)


def test_jaccard_join_on_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(SMALL).select("doc_id", "text").collect()]
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in near_found(spark, rows).collect()}
    assert got == near_truth(rows)


def test_jaccard_nulls_repeats_and_empty(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (2, "a b c d e f"), (9, None), (8, None)]
    got = sorted(near_found(spark, rows).collect(), key=str)
    assert len(got) == 5  # id 5 once, the row without an id apart
    assert {(r.doc_id, r.class_id) for r in got} == {(None, None), (2, 2), (5, 2), (8, 8), (9, 9)}
    assert near_found(spark, rows).limit(0).count() == 0
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, 2, 8, 9]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_duplicates(empty).count() == 0


def test_band_count_meets_recall():
    b = jaccard.bands_for(0.999)
    assert 1 - (1 - 0.8**jaccard.ROWS) ** b >= 0.999 > 1 - (1 - 0.8**jaccard.ROWS) ** (b - 1)


def test_shared_counts_and_components(spark):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 30)).astype(np.uint64) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = jaccard.shared_counts(sets)
    assert all(got[i][j] == want[i][j] for i in range(9) for j in range(9) if i != j)
    chain = [(i, i + 1) for i in range(20)] + [(100, 99), (100, 101), (7, 3), (5, 5)]
    df = spark.createDataFrame(chain, "a long, b long")
    got = dict(tuple(r) for r in jaccard.components(df).collect())
    assert got == {**{i: 0 for i in range(1, 21)}, 100: 99, 101: 99}


def substring_truth(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = words(t)
        gone = [False] * len(w)
        for a in range(len(w) - 19):
            if w[a : a + 20] in seen:
                gone[a : a + 20] = [True] * 20
            seen.add(w[a : a + 20])
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_substring_dedup(spark, corpus):
    small = [tuple(r) for r in spark.read.parquet(SMALL).select("doc_id", "text").collect()]
    rows = corpus + [(10_000 + i, t) for i, t in small]
    df = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, start string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.repeated_words(df).collect()}
    want = substring_truth(rows)
    assert got == want and sum(v[1] for v in want.values()) > 1000


def test_substring_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(30))
    rows = [(None, long), (4, long), (4, long), (9, long), (1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in substrings.repeated_words(df).collect())
    assert got == [(-1, 30, 0), (1, 0, 0), (4, 30, 0), (9, 30, 30)]
    assert substrings.repeated_words(df.limit(0)).count() == 0


def line_truth(rows):
    """(doc_id, text left, lines removed): both lines of every pair that an earlier place holds and that does not overlap it."""
    first = {}
    known = sorted({r for r in rows if r[0] is not None and r[1]})
    pairs = lambda x: [k for k in range(len(x) - 1) if x[k].strip() or x[k + 1].strip()]
    for i, t in known:
        lines = t.split("\n")
        for k in pairs(lines):
            first.setdefault((lines[k], lines[k + 1]), (i, t, k))
    out = []
    for i, t in rows:
        gone, lines = set(), (t or "").split("\n")
        for k in pairs(lines) if i is not None else []:
            if first[lines[k], lines[k + 1]] not in ((i, t, k), (i, t, k - 1)):
                gone |= {k, k + 1}
        out.append((i, t if not t else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone - {len(lines) - 1} if lines[-1] == "" else gone)))
    return out


def test_line_dedup(spark):
    rng = random.Random(8)
    block = [f"shared line {i}" for i in range(40)]
    rows = []
    for i in range(30):
        own = [f"own {rng.random()}" for _ in range(rng.randrange(12))]
        at = rng.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:at] + (block[rng.randrange(5) :] if i % 2 else []) + own[at:])))
    rows += [(50, "a\nb"), (51, "a\nb"), (52, None), (53, ""), (54, "\n\n\n"), (55, "\n\n\n"), (None, "\n".join(block))]
    rows += [rows[3], (7, rows[7][1])]
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, nos string, marks int")
    out = linededup.dedup_lines(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted((r[:2] for r in line_truth(rows)), key=str)
    assert sum(len(t or "") for _, t in got) < sum(len(t or "") for _, t in rows) / 2
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def test_line_report_on_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(SMALL).select("doc_id", "text").collect()]
    want = {i: (hashlib.sha256(t.encode()).hexdigest(), n) for i, t, n in line_truth(rows)}
    got = linededup.line_report(spark.read.parquet(SMALL)).collect()
    assert {r.doc_id: (r.kept_sha256, r.n_removed) for r in got} == want and sum(n for _, n in want.values())
    assert {r.doc_id: r.n_lines for r in got} == {i: t.count("\n") + 1 for i, t in rows}


def test_line_report_counts_lines_that_go(spark):
    rows = [(1, "a\nb\n"), (2, "a\nb\n"), (3, None), (4, "")]
    got = linededup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_removed) for r in got) == [(1, 3, 0), (2, 3, 2), (3, 0, 0), (4, 1, 0)]


def test_different_texts_of_one_id_lose_no_lines_of_each_other(spark):
    rows = [(1, "a\nb\nq"), (2, "a\nb\nx"), (2, "unique one\nunique two\nz"), (2, "a\nb\nx")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in linededup.dedup_lines(df).collect())
    assert got == [(1, "a\nb\nq"), (2, "unique one\nunique two\nz"), (2, "x"), (2, "x")]


def test_different_texts_of_one_id_are_joined_each_on_its_own(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(2, a, 1), (2, b, 2), (2, None, 3), (5, b + " more", 4), (1, c, 5), (2, c, 6), (2, a, 1), (7, a, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h int")
    got = sorted(map(tuple, jaccard.near_duplicates(df).collect()))
    assert got == sorted([(2, 2, 0, 1), (2, 2, 1, 0), (2, 2, 0, 0), (5, 2, 1, 0), (1, 1, 0, 1), (2, 1, 0, 1), (7, 2, 0, 1)])
    for _ in range(2):
        kept = sorted(map(tuple, jaccard.keep_one(df).collect()), key=str)
        assert kept == sorted([(2, a, 1), (2, b, 2), (2, None, 3), (1, c, 5)], key=str)


def run_truth(rows):
    """Lines in runs of two or more adjacent lines that occur at an earlier place which ends before them."""
    texts = sorted((i, t.split("\n")) for i, t in rows if i is not None and t)
    gone = {i: set() for i, _ in texts}
    places = {}
    for i, lines in texts:
        for at in range(len(lines)):
            for end in range(at + 2, len(lines) + 1):
                run = tuple(lines[at:end])
                if any((j, stop) <= (i, at) for j, stop in places.get(run, [])):
                    gone[i].update(k for k in range(at, end) if any(x.strip() for x in lines[max(at, k - 1) : min(end, k + 2)]))
                places.setdefault(run, []).append((i, end))
    return {i: "\n".join(x for k, x in enumerate(lines) if k not in gone[i]) for i, lines in texts}


def test_line_runs_go_whole_wherever_they_start(spark):
    rng = random.Random(4)
    passage = [f"passage {i}" for i in range(12)]
    rows = []
    for i in range(60):
        own = [f"own {i} {k}" for k in range(rng.randrange(1, 5))]
        a = rng.randrange(11)
        at = rng.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:at] + passage[a : a + rng.randrange(1, 5)] + own[at:])))
    rows += [(100, "x\nx\nx"), (101, "y\nx\nx\nx\nx\nz"), (102, "q\nq\nq\nq\nq"), (103, "one\n\ntwo"), (104, "one\n\nthree")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()}
    assert got == run_truth(rows)
    assert got[100] == "x\nx\nx" and got[101] == "y\nz" and got[102] == "q\nq" and got[104] == "three"
    assert sum(t.count("passage") for t in got.values()) < 40


def test_local_roots_follow_every_link():
    reps = np.array([5, 50, 7, 9, 3157, 25258, 60])
    link = np.zeros((7, 7), bool)
    for a, b in [(0, 5), (5, 4), (2, 1), (1, 3)]:  # 3157 is linked to 25258 alone, which is linked to 5
        link[a, b] = link[b, a] = True
    assert jaccard.local_roots(link, reps).tolist() == [5, 7, 7, 7, 5, 5, 60]


def test_classes_join_through_a_larger_id(spark):
    """b is near both a and c, which are not near each other; c has no link to a smaller id."""
    base = [f"t{i}" for i in range(200)]
    a, b, c = base[:], base[:], base[:]
    b[20] = b[60] = b[100] = "x"
    c[20] = c[60] = c[100] = "x"
    c[140] = c[160] = c[180] = "y"
    rows = [(1, " ".join(a)), (90, " ".join(b)), (40, " ".join(c))] + [(200 + i, " ".join(base[:150] + [f"u{i}"])) for i in range(3)]
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in near_found(spark, rows).collect()}
    want = near_truth(rows)
    assert got == want and want[40][0] == want[90][0] == 1 and want[40][1] < len(rows) - 1
