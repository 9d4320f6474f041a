"""Operator 3: language identification with a string kernel.

The blended-spectrum presence kernel counts the character n-grams (n = 1..4) that two
texts share, normalised by the geometric mean of their numbers of n-grams. Nyström
landmarks (sampled training texts) give a finite feature map, and one-versus-rest kernel
ridge regression over it gives one score per language. n-grams are hashed into
2**16 presence bits. Since the kernel is linear in those bits, landmark presences,
the Nyström root and the ridge weights multiply out to one (buckets x languages)
matrix, and texts are scored in batches by one matrix product.

The classifier is fitted on a bounded sample: at most ``per_language`` training texts of
a language and ``sample_rows`` in all, drawn by a hash of the id; languages take turns, so each
learned language has its share. The sample reaches the driver as presence bits (8 KB a text).

Defined results: null texts and texts without a letter give ``und`` with score 0, as does every text
when nothing can be learned; null languages and null ids teach nothing; repeated rows each get a
row; texts of any length are read whole; columns besides those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.text import held_out, short_batches, take_columns

BITS = 16
LONGEST = 4
PER_LANGUAGE = 256
SAMPLE_ROWS = 2048
LANDMARKS = 256
RIDGE = 1e-3
CHUNK = 64  # texts in one matrix product
UNKNOWN = "und"


def presence(text: str) -> np.ndarray:
    """Buckets of the n-grams of a text's lower-cased characters (with repeats)."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found, h = [], np.zeros(len(codes), np.uint64)
    for n in range(1, LONGEST + 1):
        if len(codes) < n:
            break
        h = h[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(n)
        mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        found.append((mixed >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(found) if found else np.zeros(0, np.int32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bits): packed presence bits of training texts."""
    for batch in batches:
        packed, langs = [], []
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            if has_letter(text):
                row = np.zeros(1 << BITS, bool)
                row[presence(text)] = True
                packed.append(np.packbits(row).tobytes())
                langs.append(lang)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(packed, pa.binary())], names=["lang", "bits"]
        )


def training_sample(documents: DataFrame, per_language: int, sample_rows: int) -> DataFrame:
    """(doc_id, lang) of the sampled learning rows: bounded by ``sample_rows``."""
    rows = take_columns(documents, {"doc_id": "bigint", "lang": "string"}).dropna()
    rows = rows.where(~held_out(F.col("doc_id")))
    turn = F.row_number().over(
        Window.partitionBy("lang").orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id")
    )
    rows = rows.withColumn("turn", turn).where(F.col("turn") <= per_language)
    return rows.orderBy("turn", "lang").limit(sample_rows).select("doc_id", "lang").distinct()


def fit(bits: np.ndarray, langs: list[str]) -> tuple[list[str], np.ndarray]:
    """Languages and the (buckets x languages) scoring matrix, from presence rows."""
    kinds = sorted(set(langs))
    x = bits.astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    y = np.where(np.array(langs)[:, None] == np.array(kinds)[None, :], 1.0, -1.0)
    z = x[:LANDMARKS]  # the sample takes languages in turn, so landmarks cover them
    kzz = (z @ z.T).astype(float)
    values, vectors = np.linalg.eigh(kzz)
    ok = values > 1e-6 * values.max()
    root = vectors[:, ok] / np.sqrt(values[ok])  # K_zz ** -1/2
    phi = (x @ z.T).astype(float) @ root
    mean = y.mean(0)  # intercept of each language's regression
    beta = np.linalg.solve(phi.T @ phi + RIDGE * len(x) * np.eye(phi.shape[1]), phi.T @ (y - mean))
    matrix = z.T.astype(float) @ (root @ beta)
    return kinds, np.vstack([matrix, mean]).astype(np.float32)


def identify(
    documents: DataFrame,
    per_language: int = PER_LANGUAGE,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every document."""
    docs = take_columns(short_batches(documents), {"doc_id": "bigint", "text": "string"})
    some = training_sample(documents, per_language, sample_rows)
    taught = docs.join(F.broadcast(some), "doc_id")
    # Ids that repeat bring more rows than ids: the bounds hold for rows, before any reaches the driver.
    own = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "text"))
    taught = taught.withColumn("turn", F.row_number().over(own)).where(F.col("turn") <= per_language)
    taught = taught.orderBy("turn", "lang").limit(sample_rows).select("lang", "text")
    sample = taught.mapInArrow(_bits, "lang string, bits binary").toPandas()
    # A fixed order that deals the languages in turn, whatever order Spark returned.
    sample = sample.sort_values(["lang", "bits"], kind="stable")
    sample["turn"] = sample.groupby("lang").cumcount()
    sample = sample.sort_values(["turn", "lang"], kind="stable").head(sample_rows)
    if len(sample):
        bits = np.array([np.unpackbits(np.frombuffer(b, np.uint8)) for b in sample["bits"]], bool)
        kinds, matrix = fit(bits, list(sample["lang"]))
    else:
        kinds, matrix = [], np.zeros((1 + (1 << BITS), 0), np.float32)
    # (2**16 + 1) x languages floats; languages are at most sample_rows.
    shared = documents.sparkSession.sparkContext.broadcast((kinds, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = shared.value
        names = np.array([*names, UNKNOWN], object)
        x = np.zeros((CHUNK, 1 << BITS), np.float32)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            pred, scores = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            todo = [i for i, t in enumerate(texts) if len(names) > 1 and has_letter(t)]
            for at in range(0, len(todo), CHUNK):
                part = todo[at : at + CHUNK]
                x[: len(part)] = 0
                for row, i in enumerate(part):
                    x[row, presence(texts[i])] = 1
                f = x[: len(part)]
                f = (f @ weights[:-1]) / np.sqrt(f.sum(1, keepdims=True)) + weights[-1]
                pred[part] = f.argmax(1)
                scores[part] = np.clip((f.max(1) + 1) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[pred], pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    out = docs.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
