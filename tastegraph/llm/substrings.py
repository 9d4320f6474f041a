"""Operator 5: substring dedup by De Bruijn compaction.

Every window of 20 consecutive words is an edge of a De Bruijn graph over words. A word is removed when
it is covered by an edge whose word sequence also starts earlier (smaller doc_id, or earlier in the
same document). The graph is never built edge by edge:

1. Documents with the same words are one path: all but the first are removed whole.
2. Each edge is represented by its minimizer, the 8-word run of smallest hash within it; equal
   edges have equal minimizers. Only minimizers (about one word in seven) are counted over the
   corpus, and only documents that hold a repeated one go on.
3. Consecutive edges with the same minimizer form a nonbranching path piece, named by a 128-bit
   digest of its words. Joins on the digest tell repeated pieces and their first place. All
   edges of a later copy of a piece are repeats.
4. The graph can branch only where one minimizer has several pieces. The edges of these pieces
   alone are compared one by one, again by digest.
5. Joins hand every repeated piece or edge its source coordinate, and runs that stay parallel to
   their source are compacted into long spans. Each span's words are compared (SHA-256) with the words
   at the source coordinates before they are removed.

Candidate texts are written once, bucketed by doc_id, to the shared scratch folder, so steps 4
and 5 read them without shuffling text. Counts are pre-aggregated; copies of a hot piece meet one
row in joins that Spark can split; only the runs of a single document are ordered together.

Defined results: null and empty texts have no words and the digest of the empty string; texts under 20
words lose nothing (nor hide others). A document is known by its doc_id: rows that repeat an id give one row, that
of the smallest digest of words; rows without an id come back whole and take no part. Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.text import short_batches, take_columns
from tastegraph.session import scratch_path

WINDOW = 20
SEED_WORDS = 8
MULTIPLIER = 0x9E3779B97F4A7C15
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def minimizers(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the minimizer of every window; of equal hashes the leftmost."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - SEED_WORDS + 1
    run = np.zeros(n, np.uint64)
    for j in range(SEED_WORDS):
        run = run * np.uint64(MULTIPLIER) + h[j : j + n]
    run ^= run >> np.uint64(32)
    run *= np.uint64(0xD6E8FEB86659FD93)
    run ^= run >> np.uint64(29)
    inside = np.lib.stride_tricks.sliding_window_view(run, WINDOW - SEED_WORDS + 1)
    at = inside.argmin(1) + np.arange(len(inside))
    return at, run[at].view(np.int64)


def pieces(words: list[bytes], repeated: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(minimizer hash, first window, number of windows) of the pieces with a repeated minimizer."""
    at, h = minimizers(words)
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    ends = np.r_[starts[1:], len(at)]
    good = np.isin(h[starts], repeated)
    yield from zip(h[starts][good].tolist(), starts[good].tolist(), (ends - starts)[good].tolist())


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_words, digest, sha) of each text."""
    for batch in batches:
        n, digests, shas = [], [], []
        for text in batch.column("text"):
            words = _words(text.as_py())
            joined = b" ".join(words)
            n.append(len(words))
            digests.append(hashlib.blake2b(joined, digest_size=16).digest())
            shas.append(hashlib.sha256(joined).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(shas)],
            names=["doc_id", "n_words", "digest", "sha"],
        )


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, doc_id, n): distinct minimizers of each text; n is 2 where it occurs at several places."""
    for batch in batches:
        seeds, ids, times = [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            words = _words(text.as_py())
            if len(words) >= WINDOW:
                at, h = minimizers(words)
                own = h[np.r_[True, at[1:] != at[:-1]]]
                found, n = np.unique(own, return_counts=True)
                seeds.append(found)
                times.append(np.minimum(n, 2))
                ids.append(np.full(len(found), doc_id))
        flat = lambda x: pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([flat(seeds), flat(ids), flat(times)], names=["seed", "doc_id", "n"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, digest, doc_id, start, n) of (doc_id, digest, text, seeds) rows."""
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            words = _words(batch.column("text")[i].as_py())
            if _digest(words) != batch.column("digest")[i].as_py():
                continue  # another row of the same id
            doc_id = batch.column("doc_id")[i].as_py()
            repeated = batch.column("seeds")[i].values.to_numpy()
            rows += [(h, _digest(words[a : a + n + WINDOW - 1]), doc_id, a, n) for h, a, n in pieces(words, repeated)]
        cols = list(zip(*rows)) if rows else [()] * 5
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)], names=["seed", "piece", "doc_id", "start", "n"]
        )


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(edge, doc_id, start) of the windows of (doc_id, digest, text, runs) rows."""
    for batch in batches:
        edges, ids, starts = [], [], []
        for i in range(batch.num_rows):
            words = _words(batch.column("text")[i].as_py())
            if _digest(words) != batch.column("digest")[i].as_py():
                continue
            doc_id = batch.column("doc_id")[i].as_py()
            for r in batch.column("runs")[i].as_py():
                for a in range(r["start"], r["start"] + r["n"]):
                    edges.append(_digest(words[a : a + WINDOW]))
                    ids.append(doc_id)
                    starts.append(a)
        yield pa.RecordBatch.from_arrays(
            [pa.array(edges, pa.binary()), pa.array(ids, pa.int64()), pa.array(starts, pa.int32())],
            names=["edge", "doc_id", "start"],
        )


def _source_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(src, src_start, n, sha): digests of the words at source coordinates."""
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            words = _words(batch.column("text")[i].as_py())
            if _digest(words) != batch.column("digest")[i].as_py():
                continue
            doc_id = batch.column("doc_id")[i].as_py()
            for s in batch.column("spans")[i].as_py():
                part = words[s["start"] : s["start"] + s["n"]]
                out.append((doc_id, s["start"], s["n"], hashlib.sha256(b" ".join(part)).digest()))
        cols = list(zip(*out)) if out else [()] * 4
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)], names=["src", "src_start", "n", "sha"]
        )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_removed, kept): what is left once the spans that equal their source are taken out."""
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            words = _words(batch.column("text")[i].as_py())
            if _digest(words) != batch.column("digest")[i].as_py():
                continue
            gone = np.zeros(len(words), bool)
            for s in batch.column("spans")[i].as_py():
                part = words[s["start"] : s["start"] + s["n"]]
                if hashlib.sha256(b" ".join(part)).digest() == s["sha"]:
                    gone[s["start"] : s["start"] + s["n"]] = True
            kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
            out.append((batch.column("doc_id")[i].as_py(), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*out)) if out else [()] * 3
        kinds = [pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "n_removed", "kept_sha256"]
        )


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written to the scratch folder in buckets of ``key``: later joins on it move no text."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"candidates_{uuid.uuid4().hex[:12]}"
    df.repartition(n, key).write.bucketBy(n, key).option("path", scratch_path(spark, name)).option(
        "compression", "zstd"
    ).saveAsTable(name)
    return spark.table(name)


def repeated_words(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every document."""
    spark = documents.sparkSession
    docs = take_columns(short_batches(documents), {"doc_id": "bigint", "text": "string"})
    summary = docs.mapInArrow(_summary, "doc_id long, n_words long, digest binary, sha string")
    one = summary.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("digest", "n_words", "sha")).alias("s"))
    one = one.select("doc_id", "s.*").checkpoint()
    long = one.where(F.col("n_words") >= WINDOW)
    first = long.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = long.join(first.where("n > 1"), "digest").where("doc_id > first").select("doc_id").checkpoint()
    heads = docs.where(F.col("doc_id").isNotNull()).join(copies, "doc_id", "left_anti")

    # Written once: they are counted, and then joined with the counts.
    path = scratch_path(spark, "seeds")
    heads.mapInArrow(_seeds, "seed long, doc_id long, n long").write.parquet(path)
    seeds = spark.read.parquet(path)
    repeated = seeds.groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed")
    hits = seeds.select("seed", "doc_id").join(repeated, "seed", "left_semi")
    hits = hits.groupBy("doc_id").agg(F.collect_set("seed").alias("seeds"))
    texts = heads.join(hits, "doc_id").join(one.select("doc_id", "digest"), "doc_id")
    texts = _bucketed(texts.select("doc_id", "digest", "text", "seeds"), "doc_id")
    read = lambda rows: texts.select("doc_id", "digest", "text").join(rows, "doc_id")

    path = scratch_path(spark, "pieces")
    texts.mapInArrow(_pieces, "seed long, piece binary, doc_id long, start int, n int").write.parquet(path)
    found = spark.read.parquet(path)
    place = F.struct("doc_id", "start")
    distinct = found.groupBy("piece").agg(
        F.first("seed").alias("seed"), F.min(place).alias("first"), F.first("n").alias("n"), F.count(F.lit(1)).alias("times")
    )
    distinct = distinct.checkpoint()
    # Later copies of a piece.
    later = found.join(distinct.where("times > 1").select("piece", "first"), "piece").where(place != F.col("first"))
    later = later.select("doc_id", "start", "n", "first.doc_id", "first.start").toDF("doc_id", "start", "n", "src", "src_start")
    # First copies of pieces at which the graph can branch: edge by edge.
    forks = distinct.groupBy("seed").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("seed")
    runs = distinct.join(forks, "seed", "left_semi").select("first.doc_id", "first.start", "n")
    runs = runs.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    path = scratch_path(spark, "edges")
    read(runs).mapInArrow(_edges, "edge binary, doc_id long, start int").write.parquet(path)
    edges = spark.read.parquet(path)
    source = edges.groupBy("edge").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    source = source.where("times > 1").select("edge", "first")
    single = edges.join(source, "edge").where(place != F.col("first"))
    single = single.select("doc_id", "start", F.lit(1).alias("n"), "first.doc_id", "first.start").toDF(
        "doc_id", "start", "n", "src", "src_start"
    )
    # Runs parallel to their source become one span.
    w = Window.partitionBy("doc_id").orderBy("start")
    shift = F.col("src_start") - F.col("start")
    broken = ~(
        (F.lag("src").over(w) == F.col("src"))
        & (F.lag(shift).over(w) == shift)
        & (F.lag(F.col("start") + F.col("n")).over(w) == F.col("start"))
    )
    spans = later.unionAll(single).withColumn("new", F.coalesce(broken, F.lit(True)).cast("int"))
    spans = spans.withColumn("span", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("doc_id", "span").agg(
        F.min("start").alias("start"), (F.sum("n") + WINDOW - 1).cast("int").alias("n"),
        F.first("src").alias("src"), F.min("src_start").alias("src_start"),
    ).drop("span").checkpoint()
    at_source = spans.select(F.col("src").alias("doc_id"), F.col("src_start").alias("start"), "n").distinct()
    at_source = at_source.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    proof = read(at_source).mapInArrow(_source_digests, "src long, src_start int, n int, sha binary")
    proved = spans.join(proof, ["src", "src_start", "n"]).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "n", "sha")).alias("spans")
    )
    cut = read(proved).mapInArrow(_removed, "doc_id long, n_removed long, kept_sha256 string")
    whole = copies.select("doc_id", F.lit(None).cast("long").alias("n_removed"), F.lit(EMPTY_SHA).alias("kept_sha256"))
    changed = cut.unionAll(whole).withColumn("changed", F.lit(True))
    out = one.join(changed, "doc_id", "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("changed"), F.coalesce("n_removed", "n_words")).otherwise(F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )
    lost = summary.where("doc_id is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256")
    )
    return out.unionAll(lost)
