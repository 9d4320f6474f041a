"""Operator 2: n-gram Jaccard join by MinHash banding.

Texts are sets of 5-word shingles (a text of one to four words is one shingle). Rows with the same words form a
*copy group* and take part once, through the smallest doc_id. Each representative gets BANDS x ROWS minimum
hashes; the band and row counts are chosen so that a pair at the threshold shares a band
with probability ``target_recall`` or more (0.999 at 0.8 gives 18 bands of 5). Spark shuffles band hashes;
every bucket of two or more representatives is then verified on the full shingle sets.

Buckets are never expanded into pair rows. A bucket's members meet in one task (large
buckets: in blocks of at most ``BLOCK`` members, every two blocks in one task), which counts
the shingles that pairs share by matrix products over the shingles that occur twice there, and returns
one row per member: how many links it has and the smallest member it is connected to within the task.
Buckets with the same members are verified once, and a pair only in the first bucket that
holds both, so links are counted exactly. Classes are connected components of links,
found with joins and pre-aggregated minima, cut by checkpoints.

Defined results: one row per document with its class id (smallest doc_id of the class), its number of links (to other
texts of Jaccard >= 0.8, counting each different text once) and of copies (other rows' ids with the same words). Null and
wordless texts have no shingles, hence no links or copies, and are their own class. A document is known by its
doc_id and text: rows alike in both share one row; different texts under one id are judged each on its own, with a row
each. Rows without an id give rows without a class. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.text import numbered, short_batches, take_columns, written

SHINGLE = 5
THRESHOLD = (4, 5)  # 0.8 as a fraction, compared in whole numbers
ROWS = 5
TARGET_RECALL = 0.999
BLOCK = 512
CELL_ROWS = 2048  # members of small buckets that share a task's group, on average
COLUMNS = 8192  # shingles in one matrix product
MULTIPLIER = 0x9E3779B97F4A7C15


def bands_for(recall: float = TARGET_RECALL, similarity: float = 0.8, rows: int = ROWS) -> int:
    """The fewest bands of ``rows`` hashes that find a pair at ``similarity`` with probability ``recall``."""
    bands = 1
    while 1 - (1 - similarity**rows) ** bands < recall:
        bands += 1
    return bands


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(SHINGLE, len(h))
    acc = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        acc = acc * np.uint64(MULTIPLIER) + h[j : len(h) - n + 1 + j]
    acc ^= acc >> np.uint64(32)
    acc *= np.uint64(0xD6E8FEB86659FD93)
    acc ^= acc >> np.uint64(29)
    return np.unique(acc)


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240117)
    return rng.integers(1, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, np.uint64)


def band_hashes(s: np.ndarray, bands: int, family) -> np.ndarray:
    """One 64-bit hash a band over its ROWS minimum hashes."""
    mul, add = family
    low = np.full(bands * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 1024):  # bounded scratch space for long texts
        part = s[a : a + 1024]
        for b in range(0, bands * ROWS, 16):
            rows = part[None, :] * mul[b : b + 16, None] + add[b : b + 16, None]
            np.minimum(low[b : b + 16], rows.min(1), out=low[b : b + 16])
    acc = np.arange(bands, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
    for j in range(ROWS):
        acc = (acc ^ low.reshape(bands, ROWS)[:, j]) * np.uint64(MULTIPLIER)
        acc ^= acc >> np.uint64(31)
    return acc.view(np.int64)


def _signatures(bands: int):
    family = _hash_family(bands * ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, rows = [], []
            for text in batch.column("text"):
                words = (text.as_py() or "").encode().split()
                digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
                rows.append(band_hashes(shingles(words), bands, family) if words else None)
            flat = [r for r in rows if r is not None]
            offsets = np.r_[0, np.cumsum([0 if r is None else bands for r in rows])].astype(np.int32)
            values = np.concatenate(flat) if flat else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("h"),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64())),
                ],
                names=["doc_id", "h", "digest", "bands"],
            )

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, keys, grams): each representative with its shingle set as bytes."""
    for batch in batches:
        grams = [shingles((t.as_py() or "").encode().split()).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("rep"), batch.column("keys"), pa.array(grams, pa.binary())], names=["rep", "keys", "grams"]
        )


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all pairwise intersections, by products over shingles that occur twice."""
    n = len(sets)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times[column] > 1
    rows, column = rows[often], column[often]
    number = np.cumsum(times > 1) - 1
    column = number[column]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    total = int(column[-1]) + 1 if len(column) else 0
    for a in range(0, total, COLUMNS):
        lo, hi = np.searchsorted(column, [a, a + COLUMNS])
        m = np.zeros((n, min(COLUMNS, total - a)), np.float32)
        m[rows[lo:hi], column[lo:hi] - a] = 1
        out += m @ m.T
    return out


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """Boolean matrix: Jaccard of the full sets at or above the threshold (not with oneself)."""
    both = shared_counts(sets).astype(np.int64)
    size = np.array([len(s) for s in sets])
    union = size[:, None] + size[None, :] - both
    top, bottom = THRESHOLD
    out = (bottom * both >= top * union) & (both > 0)
    np.fill_diagonal(out, False)
    return out


def local_roots(link: np.ndarray, reps: np.ndarray) -> np.ndarray:
    """Smallest member of each member's connected component under ``link`` (symmetric)."""
    root = reps
    while True:
        low = np.minimum(root, np.where(link, root[None, :], np.iinfo(np.int64).max).min(1))
        if (low == root).all():
            return root
        root = low


def _verify(pdf: pd.DataFrame) -> pd.DataFrame:
    """(rep, links, root) of the members of the buckets in one group of rows (key, rep, keys, grams, side).

    ``side`` is 0 in buckets that one task holds whole; in a pair of blocks it tells the blocks apart, and
    only pairs across them count (pairs within a block count where the block meets itself).
    """
    found = []
    for key, part in pdf.groupby("key", sort=False):
        part = part.drop_duplicates("rep")
        if len(part) < 2:
            continue
        reps = part["rep"].to_numpy(np.int64)
        side = part["side"].to_numpy()
        link = linked([np.frombuffer(g, np.uint64) for g in part["grams"]])
        if side.any():
            link &= side[:, None] != side[None, :]
        # A pair belongs to the smallest bucket key that holds both.
        smaller = [np.array([k for k in keys if k < key], np.int64) for keys in part["keys"]]
        if sum(map(len, smaller)):
            who = np.repeat(np.arange(len(reps)), [len(s) for s in smaller])
            _, column = np.unique(np.concatenate(smaller), return_inverse=True)
            m = np.zeros((len(reps), int(column.max()) + 1), np.float32)
            m[who, column] = 1
            link &= (m @ m.T) == 0
        links = link.sum(1)
        some = links > 0
        if some.any():
            found.append(pd.DataFrame({"rep": reps[some], "links": links[some], "root": local_roots(link, reps)[some]}))
    return pd.concat(found) if found else pd.DataFrame({"rep": [], "links": [], "root": []}, dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): smallest node of each connected component, for nodes with an edge (a, b), a != b.

    Alternating large-star and small-star rounds: each node's neighbours are joined to the
    minimum among them, found by pre-aggregation; no node's neighbours are ever collected.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "edges")
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("x"), F.col("m"), "a")
        small = small.select(F.explode(F.array(F.struct(F.col("x").alias("a"), F.col("m").alias("b")),
                                               F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
        edges = written(small.select("e.a", "e.b").where("a != b").distinct(), "edges")
        # Done when every node has one edge and leads to a node without any.
        own = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        up = own.select(F.col("a").alias("b"), F.lit(1).alias("on"))
        left = edges.join(up, "b", "left_semi").select(F.lit(1)).unionAll(own.where("n > 1").select(F.lit(1)))
        if left.isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _classes(documents: DataFrame, target_recall: float) -> DataFrame:
    """(doc_id, h, class_id, n_links, n_copies, is_head) for every doc_id and text, known by the text's hash ``h``.

    A class's head is its smallest (doc_id, h)."""
    bands = bands_for(target_recall)
    docs = take_columns(short_batches(documents), {"doc_id": "bigint", "text": "string"})
    docs = docs.withColumn("h", F.xxhash64("text"))
    known = docs.where(F.col("doc_id").isNotNull())
    marked = known.mapInArrow(_signatures(bands), "doc_id long, h long, digest binary, bands array<long>")
    marked = marked.groupBy("doc_id", "h").agg(F.min(F.struct("digest", "bands")).alias("s"))
    marked = marked.select("doc_id", "h", "s.digest", "s.bands").checkpoint()
    reps = marked.where("digest is not null").groupBy("digest").agg(
        F.min(F.struct("doc_id", "h")).alias("head"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands")
    )
    reps = reps.withColumn("rep", F.monotonically_increasing_id()).checkpoint()  # numbers that stay
    rows = reps.select("rep", F.explode("bands").alias("key"))
    # Buckets of two or more; of those with the same members only one.
    h = F.xxhash64("rep")
    buckets = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64(h, F.lit(1))).alias("y"),
        F.min("rep").alias("low"), F.max("rep").alias("high"),
    ).where("n > 1")
    buckets = buckets.groupBy("n", "x", "y", "low", "high").agg(F.min("key").alias("key")).select("key", "n")
    members = rows.join(buckets, "key").groupBy("rep").agg(F.collect_list(F.struct("key", "n")).alias("in"))
    members = members.checkpoint()  # at most ``bands`` buckets a representative
    keys = members.select("rep", F.transform("in", lambda b: b["key"]).alias("keys"))
    keys = keys.join(reps.select("rep", F.col("head.doc_id").alias("doc_id"), F.col("head.h").alias("h")), "rep")
    texts = docs.join(keys, ["doc_id", "h"]).select("rep", "keys", "text")
    sets = texts.mapInArrow(_sets, "rep long, keys array<long>, grams binary")
    sizes = members.select("rep", F.explode("in").alias("b")).select("rep", "b.key", "b.n")
    n_rows = sizes.count()
    groups = max(1, -(-n_rows // CELL_ROWS))
    # Cells: small buckets share a group; of a large one, block i meets block j >= i.
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("rep", F.lit("block")), blocks)
    span = F.sequence(F.lit(0).cast("long"), blocks - 1)
    cells = F.when(F.col("n") <= BLOCK, F.array(F.struct(
        F.pmod(F.xxhash64("key"), F.lit(groups)).alias("c"), F.lit(-1).cast("long").alias("i"), F.lit(-1).cast("long").alias("j")
    ))).otherwise(F.transform(span, lambda o: F.struct(
        F.col("key").alias("c"), F.least(own, o).alias("i"), F.greatest(own, o).alias("j")
    )))
    placed = sizes.select("rep", "key", own.alias("own"), F.explode(cells).alias("cell"))
    placed = placed.select(
        "rep", "key", "cell.*",
        F.when((F.col("cell.i") != F.col("cell.j")) & (F.col("own") == F.col("cell.j")), 1)
        .when(F.col("cell.i") != F.col("cell.j"), 2).otherwise(0).alias("side"),
    )
    full = placed.join(sets, "rep")
    checked = full.groupBy("c", "i", "j").applyInPandas(_verify, "rep long, links long, root long").checkpoint()
    links = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    classes = reps.select("digest", "rep", "n", "head").join(links, "rep", "left")
    classes = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    first = classes.groupBy("root").agg(F.min("head").alias("first"))
    classes = classes.join(first, "root").select("digest", "first", "links", "n")
    out = marked.select("doc_id", "h", "digest").join(classes, "digest", "left")
    return out.select(
        "doc_id",
        "h",
        F.coalesce("first.doc_id", "doc_id").alias("class_id"),
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce(F.col("n") - 1, F.lit(0).cast("long")).alias("n_copies"),
        F.coalesce(F.col("first") == F.struct("doc_id", "h"), F.lit(True)).alias("is_head"),
    )


def near_duplicates(documents: DataFrame, target_recall: float = TARGET_RECALL) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies) for every document."""
    cols = ["doc_id", "class_id", "n_links", "n_copies"]
    none = F.lit(0).cast("long")
    lost = take_columns(documents, {"doc_id": "bigint"}).where(F.col("doc_id").isNull()).select(
        "doc_id", F.lit(None).cast("long").alias("class_id"), none.alias("n_links"), none.alias("n_copies")
    )
    return _classes(documents, target_recall).select(*cols).unionAll(lost)


def keep_one(documents: DataFrame, target_recall: float = TARGET_RECALL) -> DataFrame:
    """One row of ``documents`` for each class: its head's. Rows without an id stay."""
    cols = documents.columns
    rows, key, text = numbered(documents), f"c{cols.index('doc_id')}", f"c{cols.index('text')}"
    heads = _classes(documents, target_recall).where("is_head").select(F.col("doc_id").alias("head"), "h")
    named = rows.withColumns({"head": F.col(key).cast("bigint"), "h": F.xxhash64(F.col(text).cast("string"))})
    kept = named.join(heads, ["head", "h"])
    # Rows alike in id and text: the one of the smallest hash of all columns.
    row = F.struct(*rows.columns)
    kept = kept.groupBy("head", "h").agg(F.min_by(row, F.xxhash64(*rows.columns)).alias("row")).select("row.*")
    return kept.unionAll(rows.where(F.col(key).isNull())).toDF(*cols)
