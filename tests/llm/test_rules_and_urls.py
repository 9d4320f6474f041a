"""Quality rules and URL filters against brute force, and their defined results on odd input."""

import random
import re

from tastegraph.llm import quality, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    hit = {i + o for i, x in enumerate(windows) if windows.count(x) > 1 for o in range(3)}
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
    )


TEXTS = [
    None, "", "   \n\t", "one", "a b a b a b a b", "x\ny\nx\n\n \nx", "é ü 🎉 # | <>\x0bw\x0cv\rz",
    "the cat sat on the mat " * 30, "of the " * 60, " ".join(f"word{i} the" for i in range(40)),
    "a b c a b c\na b c", "- point\n- point two\n" + "and the rest of it " * 20, "WORD!! SHOUT!! " * 40,
]


def test_base_counts_match_brute_force(spark):
    rows = [(i, t, "x", 7) for i, t in enumerate(TEXTS)] + [(3, "one", "again", 1), (None, "a b c", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    got = quality.quality_rules(df).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_words): r for r in got}
    for i, t, *_ in rows:
        c = base_counts(t)
        r = by[i, c[0]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c, t
        assert r.base_failed == (c[0] < 50 or 100 * c[4] > 50 * c[0])
        assert not (r.base_failed and r.kept)


def test_verdict_follows_quality_labels(spark):
    d = "/root/testdata/sf0.01"
    got = quality.quality_rules(spark.read.parquet(f"{d}/documents.parquet")).where("not base_failed")
    seen = got.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").select("kept", "quality").collect()
    assert len(seen) > 100 and all(r.kept == (r.quality == 1) for r in seen)


def test_rules_are_one_projection(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = quality.quality_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert quality.quality_rules(df.limit(0)).count() == 0


def judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if url and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else "allow"


def test_url_filters_match_brute_force(spark):
    rng = random.Random(5)
    rules = urls.DEMO_RULES + [("a.b.c", "/x", "block"), ("b.c", "/x/y/z", "allow"), ("c", "", "block"), ("c", "/", "allow")]
    hosts = ["com", "example.com", "WWW.Example.com", "a.b.c", "q.a.b.c", "b.c", "xb.c", "net", "m.net", "a..net", "ÉX.com"]
    paths = ["", "/", "/en/", "/en", "/en/7", "/es/1/2", "/fr/", "/x", "/xy", "/x/y/z", "/x/y/zz/1", "//", "/es//"]
    pages = [(i, f"{s}://{rng.choice(hosts)}{rng.choice(paths)}{t}", "junk") for i, (s, t) in
             enumerate((s, t) for s in ("http", "https", "") for t in ("", "?a=/en/", "#x", "?q#r") for _ in range(12))]
    pages += [(900, None, "a"), (901, "no scheme", "b"), (902, "x://", "c"), (None, "http://example.com/en/", "d"),
              (903, "http://h/" + "a/" * 500, "e"), (903, "http://h/" + "a/" * 500, "e")]
    df = spark.createDataFrame(pages, "page_id long, url string, rule string")
    table = spark.createDataFrame([*rules, (None, "/", "block")], "host string, path string, verdict string")
    got = sorted((r.page_id or -1, r.host, r.path, r.rule or "", r.verdict) for r in urls.filter_urls(df, table).collect())
    want = [(i or -1, *judge(u, rules)) for i, u, _ in pages]
    assert got == sorted((i, h, p, r or "", v) for i, h, p, r, v in want)
    none = urls.filter_urls(df, table.limit(0)).collect()
    assert len(none) == len(pages) and {r.verdict for r in none} == {"allow"}
