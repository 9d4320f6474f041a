"""Operator 8: toxicity by class-conditional Kneser-Ney models.

Two character 5-gram models, one of toxic and one of ordinary words, share their
back-off: the orders up to two use continuation counts pooled over both classes, so an
expression that is rare in both gets the same probability from both in the end. A text's score
compares the two log-likelihoods, normalised by length: a character over the whole text, and a
word over its four most telling words; a logistic curve over these two turns them into 0..1.

Spark counts the n-grams of every labelled training text and computes all statistics, keyed by the
n-gram or context itself, at every size. Tables of at most ``LOCAL_KEYS`` keys are sent to the tasks packed, 16 bytes a key
(``Packed``), and words are looked up in them by the thousand; larger ones stay distributed: the distinct words' n-grams are
joined to them for one ratio a word, and word ratios are joined to the texts' counted words. Both ways give the same evidence. The logistic curve is fitted on at
most ``fit_rows`` labelled rows, each judged by the counts of the half it is not in.

Defined results: null and wordless texts get the curve's value at zero evidence; a label
row that repeats counts once, and toxic if any repeat says so; null labels teach nothing;
without both classes among the training labels the score is the share of toxic ones (0 with
none). Repeated documents each get a row. Columns besides those named are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.text import held_out, numbered, short_batches, take_columns

ORDER = 5
SHARED = 2  # orders up to this one are pooled over both classes
LOCAL_KEYS = 8_000_000  # n-grams and contexts that tasks look up in memory, 16 bytes each; more are joined
TRIPLES = (1 << 22) - 1  # different last three characters of them: they are numbered in 22 bits
DISCOUNT = 0.75
TELLING = 4  # words that the second comparison looks at
MOST = 15.0  # log-ratio that counts for one of them at most
THRESHOLD = 0.7
FIT_ROWS = 20_000
FLUSH = 500_000  # n-grams a task holds before it hands them on
MEMO = 500_000  # words whose ratio a task remembers
SLICE_CHARS = 1_000_000  # characters of the texts whose words are looked up at once, or one text
WINDOWS = 250_000  # n-grams that are looked up at once
COUNTS = ["plain0", "toxic0", "plain1", "toxic1"]


@dataclass
class Model:
    """Log-ratios (key, r) by n-gram seen and by context, packed or as DataFrames, and the logistic weights."""

    grams: Packed | DataFrame
    contexts: Packed | DataFrame
    weights: np.ndarray  # intercept, whole text, telling words


class Packed:
    """Log-ratios of keys of two to five characters, sorted by an exact 64-bit code for each length.

    ``triples`` are the different last three characters of keys (21 bits a character, sorted); a triple's number, from 1
    on, and the characters before it are the code of a longer key."""

    def __init__(self, keys: dict[int, np.ndarray], ratios: dict[int, np.ndarray], triples: np.ndarray):
        self.triples, self.tables = triples, {}
        for n, chars in keys.items():
            codes = _code(chars.T, n, _numbers(_triple(chars.T, n - 3), triples) if n > 2 else None)
            order = np.argsort(codes)
            self.tables[n] = codes[order], ratios[n][order]

    def find(self, n: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(r, found) of codes of n characters; r is 0 where there is none."""
        known, r = self.tables.get(n, (np.zeros(0, np.uint64), np.zeros(0)))
        if not len(known):
            return np.zeros(len(codes)), np.zeros(len(codes), bool)
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        found = known[at] == codes
        return np.where(found, r[at], 0.0), found


def _triple(chars: np.ndarray, at: int) -> np.ndarray:
    a, b, c = (chars[at + i].astype(np.uint64) for i in range(3))
    return a << np.uint64(42) | b << np.uint64(21) | c


def _numbers(triples: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The numbers of triples, 0 for one that no key ends with."""
    if not len(known):
        return np.zeros(len(triples), np.uint64)
    at = np.minimum(np.searchsorted(known, triples), len(known) - 1)
    return np.where(known[at] == triples, at + 1, 0).astype(np.uint64)


def _code(chars: np.ndarray, n: int, last: np.ndarray | None) -> np.ndarray:
    """Codes of keys whose n characters are the first rows of ``chars`` and whose last three have the numbers ``last``."""
    if n == 2:
        return chars[0].astype(np.uint64) << np.uint64(21) | chars[1].astype(np.uint64)
    if n == 3:
        return last
    if n == 4:
        return chars[0].astype(np.uint64) << np.uint64(22) | last
    return chars[0].astype(np.uint64) << np.uint64(43) | chars[1].astype(np.uint64) << np.uint64(22) | last


def _by_length(table: pa.Table) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """The keys of (key, r) rows as a matrix of characters for each length, and their ratios."""
    keys, ratios = {}, {}
    for part in table.to_batches(max_chunksize=WINDOWS):
        text = part.column(0).to_pylist()
        lengths, chars = np.fromiter(map(len, text), np.int64, len(text)), np.frombuffer("".join(text).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(lengths)
        for n in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == n)
            keys.setdefault(n, []).append(chars[(ends[own] - n)[:, None] + np.arange(n)])
            ratios.setdefault(n, []).append(part.column(1).to_numpy()[own])
    return {n: np.concatenate(c) for n, c in keys.items()}, {n: np.concatenate(r) for n, r in ratios.items()}


def packed(*tables: pa.Table) -> list[Packed]:
    """Tables (key, r) packed with common triples."""
    parts = [_by_length(t) for t in tables]
    found = [_triple(chars.T, n - 3) for keys, _ in parts for n, chars in keys.items() if n > 2]
    triples = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]))
    return [Packed(*p, triples) for p in parts]


def _grams(word: str) -> list[str]:
    padded = " " * (ORDER - 1) + word + " "
    return [padded[i : i + ORDER] for i in range(len(word) + 1)]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, plain0, toxic0, plain1, toxic1) partial counts, by half, of (text, toxic, half) rows."""
    words = tuple(Counter() for _ in range(4))

    def flush() -> pa.RecordBatch:
        counts: dict[str, list[int]] = {}
        for cls, seen in enumerate(words):
            for w, n in seen.items():
                for g in _grams(w):
                    counts.setdefault(g, [0, 0, 0, 0])[cls] += n
            seen.clear()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(counts), pa.string()),
                *(pa.array([c[k] for c in counts.values()], pa.int64()) for k in range(4)),
            ],
            names=["gram", *COUNTS],
        )

    for batch in batches:
        for text, toxic, half in zip(*(batch.column(k).to_pylist() for k in range(3))):
            words[2 * half + toxic].update(text.lower().split())
            if sum(map(len, words)) >= FLUSH:
                yield flush()
    yield flush()


def _rest(c: str) -> Column:
    """The mass that a class's context leaves to the order below."""
    n = F.col(f"n_{c}")
    return F.when(n > 0, DISCOUNT * F.col(f"t_{c}") / n).otherwise(F.lit(1.0))


def _below(level: DataFrame, n: int, classes: list[str]) -> DataFrame:
    """Continuation counts: of how many kinds of n-grams is each (n-1)-gram the end, per class."""
    kinds = [F.sum((F.col(c) > 0).cast("double")).alias(c) for c in classes]
    return level.groupBy("v", F.right("g", F.lit(n - 1)).alias("g")).agg(*kinds).checkpoint()


def _contexts(level: DataFrame, n: int, classes: list[str]) -> DataFrame:
    """Per context of n-1 characters and class: the counts that follow it, and of how many kinds."""
    sums = [F.sum(c).alias(f"n_{c}") for c in classes]
    kinds = [F.sum((F.col(c) > 0).cast("double")).alias(f"t_{c}") for c in classes]
    return level.groupBy("v", F.left("g", F.lit(n - 1)).alias("ctx")).agg(*sums, *kinds).checkpoint()


def _smoothed(level: DataFrame, contexts: DataFrame, n: int, lower: DataFrame, classes: list[str]) -> DataFrame:
    """(v, g, p of each class, its count): discounted counts plus the context's rest times the order below.

    Every level is checkpointed: the tables are small beside the text, and plans stay short."""
    level = level.withColumn("ctx", F.left("g", F.lit(n - 1))).withColumn("low", F.right("g", F.lit(n - 1)))
    lower = lower.select("v", F.col("g").alias("low"), *(F.col(f"p_{c}").alias(f"low_{c}") for c in classes))

    def p(c: str) -> Column:
        seen = F.col(f"n_{c}")
        own = F.when(seen > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / seen).otherwise(F.lit(0.0))
        return (own + _rest(c) * F.col(f"low_{c}")).alias(f"p_{c}")

    joined = level.join(contexts, ["v", "ctx"]).join(lower, ["v", "low"])
    return joined.select("v", "g", *map(p, classes), *classes).checkpoint()


def _log_ratios(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(v, key, r) with log(p_toxic / p_plain): of seen n-grams, and of contexts for unseen ones.

    ``grams`` has rows (v, g, toxic, plain); every v is a corpus of its own."""
    classes = ["toxic", "plain"]
    levels = {ORDER: grams}
    for n in range(ORDER, SHARED + 1, -1):
        levels[n - 1] = _below(levels[n], n, classes)
    # Shared orders: kinds of longer n-grams of either class.
    shared = {SHARED + 1: levels[SHARED + 1].select("v", "g", F.lit(1.0).alias("both"))}
    for n in range(SHARED + 1, 1, -1):
        shared[n - 1] = _below(shared[n], n, ["both"])
    total = _contexts(shared[1], 1, ["both"]).drop("ctx")
    share = (F.col("both") + 1) / (F.col("n_both") + F.col("t_both") + 1)
    p = shared[1].join(total, "v").select("v", "g", share.alias("p_both"))
    for n in range(2, SHARED + 1):
        p = _smoothed(shared[n], _contexts(shared[n], n, ["both"]), n, p, ["both"])
    p = p.select("v", "g", F.col("p_both").alias("p_toxic"), F.col("p_both").alias("p_plain"))
    ratios, rests = [], []
    for n in range(SHARED + 1, ORDER + 1):
        contexts = _contexts(levels[n], n, classes)
        p = _smoothed(levels[n], contexts, n, p, classes)
        ratios.append(p.select("v", "g", F.log(F.col("p_toxic") / F.col("p_plain")).alias("r")))
        rest = F.log(_rest("toxic") / _rest("plain"))
        rests.append(contexts.select("v", "ctx", rest.alias("r")))

    return tuple(reduce(DataFrame.unionAll, parts).toDF("v", "key", "r") for parts in (ratios, rests))


class _Scorer(dict):
    """Log-ratio of each word seen so far; ``evidences`` of texts from them."""

    def __init__(self, model: Model):
        super().__init__()
        self.grams, self.contexts = model.grams, model.contexts

    def __missing__(self, w: str) -> float:
        self._learn({w})
        return self[w]

    def _learn(self, words: set[str]) -> None:
        """Look up the ratios of those of ``words`` that are not remembered."""
        new = words.difference(self)
        if len(self) + len(new) > MEMO:
            self.clear()
            new = words
        if new:
            new = list(new)
            self.update(zip(new, self._ratios(new).tolist()))

    def _ratios(self, words: list[str]) -> np.ndarray:
        """The sum of each word's n-grams' log-ratios."""
        pad = " " * (ORDER - 1)
        chars = np.frombuffer("".join(f"{pad}{w} " for w in words).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + ORDER)
        starts = np.r_[0, ends[:-1]]
        r, inside = np.zeros(len(chars)), np.ones(len(chars), bool)
        for i in range(1, ORDER):
            inside[ends - i] = False  # an n-gram that began there would reach into the next word
        for at in range(0, len(chars), WINDOWS):
            begins = at + np.flatnonzero(inside[at : at + WINDOWS])
            r[begins] = self._windows(chars[begins[:, None] + np.arange(ORDER)].T)
        return np.add.reduceat(r, starts)

    def _windows(self, chars: np.ndarray) -> np.ndarray:
        """The log-ratio of each n-gram of the highest order, a column of characters; unseen ones back off, in the end to what both classes share."""
        total, left = np.zeros(chars.shape[1]), np.arange(chars.shape[1])
        last = _numbers(_triple(chars, ORDER - 3), self.grams.triples)
        for n in range(ORDER, SHARED, -1):
            own = chars[ORDER - n :, left]
            r, found = self.grams.find(n, _code(own, n, last[left]))
            total[left] += r
            left, own = left[~found], own[:, ~found]
            if not len(left):
                break
            before = _numbers(_triple(own, n - 4), self.contexts.triples) if n > 3 else None
            total[left] += self.contexts.find(n - 1, _code(own, n - 1, before))[0]
        return total

    def evidences(self, texts: list[str | None]) -> list[tuple[float, float]]:
        """(whole, telling) of each text: length-normalised log-ratios."""
        out, part, size = [], [], 0
        for i, text in enumerate(texts):
            part.append((text or "").lower().split())
            size += len(text or "")
            if size >= SLICE_CHARS or i + 1 == len(texts):
                self._learn(set().union(*part))
                out += map(self._evidence, part)
                part, size = [], 0
        return out

    def _evidence(self, words: list[str]) -> tuple[float, float]:
        n = len(words)
        if not n:
            return 0.0, 0.0
        ratio = np.fromiter(map(self.__getitem__, words), np.float64, n)
        whole = ratio.sum() / (sum(map(len, words)) + n)
        k = min(TELLING, n)
        telling = np.minimum(np.partition(ratio, n - k)[-k:], MOST).sum() / TELLING
        return float(whole), float(telling)


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_key, word, n): the words of each text and how often each occurs, of (text_key, text) rows."""
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = Counter(text.lower().split())
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(seen), pa.string()), pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["text_key", "word", "n"],
            )


def _grams_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, g, times): the n-grams of the highest order of each word."""
    for batch in batches:
        rows = [(w, g, n) for w in batch.column(0).to_pylist() for g, n in Counter(_grams(w)).items()]
        cols = list(zip(*rows)) if rows else [()] * 3
        kinds = [pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["word", "g", "times"])


def _joined_evidence(rows: DataFrame, model: Model, keep: list[str], text_col: str) -> DataFrame:
    """``_evidence`` by joins: no task holds more of the model than its share. Texts are known by their SHA-256."""
    texts = short_batches(rows).select(*keep, F.col(text_col).cast("string").alias("_text"))
    texts = texts.withColumn("_key", F.sha2("_text", 256))
    counts = texts.where(F.col("_text").isNotNull()).select("_key", "_text")
    counts = counts.mapInArrow(_counted_words, "text_key string, word string, n long")
    counts = counts.dropDuplicates(["text_key", "word"]).checkpoint()
    parts = counts.select("word").distinct().mapInArrow(_grams_of_words, "word string, g string, times long").checkpoint()
    grams, ratio = parts.select("g").distinct(), F.lit(0.0)
    for n in range(ORDER, SHARED, -1):
        g = F.right("g", F.lit(n))
        seen = model.grams.select(F.col("key").alias(f"g{n}"), F.col("r").alias(f"seen{n}"))
        rest = model.contexts.select(F.col("key").alias(f"c{n}"), F.col("r").alias(f"rest{n}"))
        grams = grams.withColumn("own", g).join(seen, F.col("own") == F.col(f"g{n}"), "left")
        grams = grams.withColumn("ctx", F.left("own", F.lit(n - 1))).join(rest, F.col("ctx") == F.col(f"c{n}"), "left")
        grams = grams.drop("own", "ctx", f"g{n}", f"c{n}")
    for n in range(SHARED + 1, ORDER + 1):
        ratio = F.coalesce(F.col(f"seen{n}"), F.coalesce(F.col(f"rest{n}"), F.lit(0.0)) + ratio)
    words = parts.join(grams.select("g", ratio.alias("r")), "g").groupBy("word").agg(F.sum(F.col("r") * F.col("times")).alias("r"))
    most = F.flatten(F.collect_list(F.array_repeat("r", F.least("n", F.lit(TELLING)).cast("int"))))
    top = F.slice(F.sort_array(most, asc=False), 1, TELLING)
    evidence = counts.join(words, "word").groupBy("text_key").agg(
        (F.sum(F.col("r") * F.col("n")) / F.sum((F.length("word") + 1) * F.col("n"))).alias("_whole"),
        (F.aggregate(top, F.lit(0.0), lambda a, x: a + F.least(x, F.lit(MOST))) / TELLING).alias("_telling"),
    )
    none = lambda c: F.coalesce(c, F.lit(0.0))
    joined = texts.drop("_text").join(evidence, F.col("_key") == F.col("text_key"), "left")
    return joined.select(*keep, none("_whole").alias("whole"), none("_telling").alias("telling"))


def _evidence(rows: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """(``keep`` columns, whole, telling) for every row."""
    if not isinstance(model.grams, Packed):
        return _joined_evidence(rows, model, keep, text_col)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # at most LOCAL_KEYS keys
    names = [*keep, "whole", "telling"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches):
        scorer = _Scorer(shared.value)
        for batch in batches:
            got = scorer.evidences(batch.column("_text").to_pylist())
            extra = [pa.array([g[i] for g in got], pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *extra], names=names)

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keep), "whole double", "telling double"])
    return short_batches(rows).select(*keep, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic regression on standardised columns, by Newton
    steps that are halved until the loss falls, so separable classes give finite weights too."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    penalty = np.diag([0.0, *[ridge] * x.shape[1]])

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, z @ w).sum() - y @ (z @ w) + w @ penalty @ w / 2)

    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        slope = z.T @ (p - y) + penalty @ w
        curve = (z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(len(w))
        step, size = np.linalg.solve(curve, slope), 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    raw = w[1:] / scale
    return np.r_[w[0] - raw @ mean, raw]


def _labelled(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) and (doc_id, toxic) of the fold that may be learned from."""
    docs = take_columns(short_batches(documents), {"doc_id": "bigint", "text": "string"})
    docs = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    marks = take_columns(labels, {"doc_id": "bigint", "toxic": "int"}).dropna()
    marks = marks.where(~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    return docs, marks


def train(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Counts over all labelled rows of the learning fold; the curve from at most ``fit_rows`` of them."""
    docs, marks = _labelled(documents, labels)
    by_class = dict(marks.groupBy("toxic").count().collect())
    if len(by_class) < 2:
        share = 0.0 if not by_class.get(1) else 1.0
        bias = math.log((share + 1e-9) / (1 - share + 1e-9))
        nothing = pa.table({"key": pa.array([], pa.string()), "r": pa.array([], pa.float64())})
        return Model(*packed(nothing, nothing), np.array([bias, 0.0, 0.0]))
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int")
    grams = (
        docs.join(marks.hint("shuffle_hash"), "doc_id").select("text", "toxic", half.alias("half"))
        .mapInArrow(_count_grams, "gram string, " + ", ".join(f"{c} long" for c in COUNTS))
        .groupBy("gram").agg(*(F.sum(c).alias(c) for c in COUNTS))
    )
    # Corpus 0: all labelled texts. Corpora 1 and 2: the halves, for the curve.
    corpora = F.array(
        *(
            F.struct(F.lit(v).alias("v"), F.expr(t).cast("double").alias("toxic"), F.expr(n).cast("double").alias("plain"))
            for v, t, n in [(0, "toxic0 + toxic1", "plain0 + plain1"), (1, "toxic0", "plain0"), (2, "toxic1", "plain1")]
        )
    )
    grams = grams.select(F.col("gram").alias("g"), F.inline(corpora)).select("v", "g", "toxic", "plain")
    tables = _log_ratios(grams.where("toxic + plain > 0").checkpoint())

    def model_of(v: int) -> Model:
        own = [t.where(F.col("v") == v).select("key", "r") for t in tables]
        n = sum(t.count() for t in own)
        if n <= LOCAL_KEYS and (n <= TRIPLES or reduce(DataFrame.unionAll, own).select(F.right("key", F.lit(3))).distinct().count() <= TRIPLES):
            own = packed(*(t.toArrow() for t in own))
        return Model(*own, np.zeros(3))

    # At most fit_rows ids by a fixed shuffle of the ids: bounded, so broadcast. Each half of them is judged by
    # the counts of the other, so the curve sees evidence as new texts give it.
    some = marks.orderBy(F.xxhash64(F.lit("fit"), "doc_id"), "doc_id").limit(fit_rows)
    rows = docs.join(F.broadcast(some), "doc_id")
    fit = pd.concat(
        [_evidence(rows.where(half == h), model_of(2 - h), ["doc_id", "toxic"]).toPandas() for h in (0, 1)]
    ).sort_values(["doc_id", "whole", "telling"])
    model = model_of(0)
    if 0 < fit["toxic"].sum() < len(fit):
        model.weights = _logistic(fit[["whole", "telling"]].to_numpy(), fit["toxic"].to_numpy(float))
    return model


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    docs = take_columns(documents, {"doc_id": "bigint", "text": "string"})
    out = _evidence(docs, model, ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), probability(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def probability(model: Model) -> Column:
    b, whole, telling = (float(w) for w in model.weights)
    z = F.lit(b) + whole * F.col("whole") + telling * F.col("telling")
    return 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` (all their columns) that the model does not call toxic."""
    model = train(documents, labels)
    cols, rows = documents.columns, numbered(documents)
    out = _evidence(rows, model, rows.columns, f"c{cols.index('text')}")
    return out.where(probability(model) < THRESHOLD).select(*rows.columns).toDF(*cols)
