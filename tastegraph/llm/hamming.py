"""Operator 11: near duplicates by a multi-index Hamming join of b-bit signatures.

Texts are sets of two-word shingles (A-Z lower-cased; a text of one word is one shingle). Rows with the same set form a
*node* and take part once. A node's signature holds the lowest BITS bits of POSITIONS minimum hashes; the distance of two
signatures is the number of positions that differ. Two sets of Jaccard 0.8 are within the distance threshold
with probability ``target_recall`` (0.999: 28 of 80 positions), more similar ones almost surely.

*Multi-index join.* The positions are split into chunks with error allowances a_i, where the sum of (a_i + 1) exceeds
the threshold: by the pigeonhole principle two signatures within the threshold differ in at most a_i positions of some
chunk i. The allowed errors are enumerated by leaving every choice of a_i positions out of the chunk: each node emits one
key a choice, and every pair within the threshold shares a key. Here that is 14 chunks with one
error each, 80 keys a node, each over five or so positions of 16 bits.

*Confirming.* Only components are asked for, so a bucket of n nodes is not expanded into n * n pairs. First, each node
meets its bucket's smallest node (a star, n - 1 pairs): distance, then the full sets. Components of these links
label the nodes. Then, in buckets that still hold several labels, the nodes outside the most common label meet
all nodes of other labels, in blocks of bounded size: by distance on signatures, and only nodes with a partner
within the threshold then bring their full sets to the same blocks. A bucket of near copies of one text
is thus done after its star, in linear work. Pairs within one label need no check, as they change nothing.

Defined results: one row per input row. Null, empty and wordless texts have no shingles and are their own component.
Rows are known by their text's set, so rows that repeat a doc_id with other texts are judged each on its own. A row
without a doc_id links with nothing: its component_id is null and it is kept. Other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.jaccard import components
from tastegraph.llm.text import short_batches, take_columns, written

SHINGLE = 2
THRESHOLD = (80, 100)  # least share of the union that the intersection takes
POSITIONS = 80
BITS = 16
TARGET_RECALL = 0.999
BLOCK = 512  # nodes of each side that meet in a cell, on average, if both are many
LONGEST = 8  # times BLOCK: the longest block that fewer nodes than BLOCK meet
CELL_ROWS = 4096  # rows of small buckets that share a group, on average
SET_ROWS = 512  # the same where rows bring their full sets
MIX = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def distance_for(recall: float = TARGET_RECALL, similarity: float = 0.8, positions: int = POSITIONS) -> int:
    """The least distance that a pair at ``similarity`` keeps to with probability ``recall``."""
    miss, within = 1 - similarity, 0.0
    for r in range(positions + 1):
        within += comb(positions, r) * miss**r * (1 - miss) ** (positions - r)
        if within >= recall:
            return r
    return positions


def chunk_plan(positions: int, distance: int, errors: int = 1) -> list[tuple[int, int, int]]:
    """(first position, position after the last, allowed errors) of each chunk; the sum of (errors + 1) is distance + 1."""
    allowed, left = [], distance + 1
    while left > 0:
        allowed.append(min(errors, left - 1))
        left -= allowed[-1] + 1
    cuts = [round(positions * i / len(allowed)) for i in range(len(allowed) + 1)]
    return list(zip(cuts, cuts[1:], allowed))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(29))


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(size, len(h))
    acc = np.full(len(h) - n + 1, n, np.uint64)
    for j in range(n):
        acc = acc * np.uint64(MIX[0]) + h[j : len(h) - n + 1 + j]
    return np.unique(_mixed(acc))


def _family(positions: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(811)
    return rng.integers(1, 2**63, positions, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, positions, np.uint64)


def signature(s: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """BITS bits of each minimum hash of the (non-empty) set ``s``."""
    mul, add = family
    low = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 1024):  # bounded scratch space for long texts
        part = s[a : a + 1024]
        for b in range(0, len(mul), 16):
            np.minimum(low[b : b + 16], (part[None, :] * mul[b : b + 16, None] + add[b : b + 16, None]).min(1), out=low[b : b + 16])
    return (_mixed(low) >> np.uint64(64 - BITS)).astype(np.uint16)


def signature_keys(sigs: np.ndarray, plan: list[tuple[int, int, int]]) -> np.ndarray:
    """One 64-bit key a row of ``sigs`` and choice of left-out positions."""
    place = np.arange(1, sigs.shape[1] + 1, dtype=np.uint64) * np.uint64(MIX[0])
    h = _mixed(sigs.astype(np.uint64) * np.uint64(MIX[1]) + place)
    keys = []
    for start, stop, errors in plan:
        whole = h[:, start:stop].sum(1, dtype=np.uint64)
        for out in combinations(range(start, stop), errors):
            choice = np.uint64((len(keys) + 1) * MIX[0] % 2**64)
            keys.append(_mixed(whole - h[:, list(out)].sum(1, dtype=np.uint64) + choice))
    return np.stack(keys, 1).view(np.int64)


def overlap_links(a: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the sorted sets ``others`` are at least THRESHOLD similar to the sorted set ``a`` (none empty)."""
    sizes = np.array([len(b) for b in others])
    every = np.concatenate(others)
    hit = a[np.minimum(np.searchsorted(a, every), len(a) - 1)] == every
    both = np.add.reduceat(hit.astype(np.int64), np.r_[0, np.cumsum(sizes)[:-1]])
    top, bottom = THRESHOLD
    return bottom * both >= top * (len(a) + sizes - both)


# --- functions that run in tasks ---------------------------------------------------
def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_shingles, digest, sig) of each row (doc_id, text as bytes)."""
    family = _family(POSITIONS)
    for batch in batches:
        sizes, digests, sigs = [], [], []
        for text in batch.column(1):
            s = shingle_set(text.as_py() or b"")
            sizes.append(len(s))
            digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            sigs.append(signature(s, family).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())],
            names=["doc_id", "n_shingles", "digest", "sig"],
        )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), POSITIONS)


def _spread(plan: list[tuple[int, int, int]]):
    """(node, sig) to one (key, node) row a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = signature_keys(_matrix(batch.column(1)), plan)
                nodes = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(nodes)], names=["key", "node"])

    return run


def _near(distance: int):
    """Of (a, b, sketch_a, sketch_b) the pairs (a, b) of like sizes within the distance."""
    top, bottom = THRESHOLD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = batch.column(2), batch.column(3)
                apart = (_matrix(a.field("sig")) != _matrix(b.field("sig"))).sum(1)
                sizes = np.stack([x.field("size").to_numpy() for x in (a, b)])
                near = (apart <= distance) & (sizes.min(0) * bottom >= sizes.max(0) * top)
                yield batch.filter(pa.array(near)).select([0, 1])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sig, grams) of rows (node, digest, sig, text as bytes) whose text has that digest."""
    for batch in batches:
        nodes, sigs, grams = [], [], []
        for node, digest, sig, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            s = shingle_set(text or b"").tobytes()
            if hashlib.blake2b(s, digest_size=16).digest() == digest:
                nodes.append(node)
                sigs.append(sig)
                grams.append(s)
        columns = [pa.array(nodes, pa.int64()), pa.array(sigs, pa.binary()), pa.array(grams, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "sig", "grams"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, grams_a, grams_b) the linked pairs (a, b)."""
    for batch in batches:
        pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        keep = [overlap_links(np.frombuffer(x, np.uint64), [np.frombuffer(y, np.uint64)])[0] for x, y in pairs]
        yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])


def _candidates(part: pd.DataFrame, distance: int, plan: list[tuple[int, int, int]]) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows): each row of the queries' side and the rows of other labels within the distance, of one cell.

    A pair counts in the smallest key that both share, and in no other bucket. (Of buckets with the same nodes the
    smallest key was kept, so that key has a bucket.)"""
    sigs = np.frombuffer(b"".join(part["sig"]), np.uint16).reshape(len(part), POSITIONS)
    keys, key = signature_keys(sigs, plan), part["key"].iloc[0]
    label, side = part["label"].to_numpy(), part["side"].to_numpy()
    asked, every = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    for i in asked:
        near = every[(label[every] != label[i]) & ((sigs[every] != sigs[i]).sum(1) <= distance)]
        shared = np.where(keys[near] == keys[i], keys[i], np.iinfo(np.int64).max)
        yield i, near[shared.min(1) == key]


def _mark_cells(distance: int, plan: list[tuple[int, int, int]]):
    """(key, x, y, node, label, side) of the rows of a group of cells that have a partner within the distance."""
    cols = ["key", "x", "y", "node", "label", "side"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, part in pdf.groupby(["key", "x", "y"], sort=False):
            some = np.zeros(len(part), bool)
            for i, partners in _candidates(part, distance, plan):
                some[partners] = True
                some[i] |= len(partners) > 0
            if some.any():
                found.append(part.loc[some, cols])
        return pd.concat(found) if found else pdf.loc[[], cols]

    return run


def _join_cells(distance: int, plan: list[tuple[int, int, int]]):
    """(a, b) links of a group of cells, at most one a label of partners and node: more would link the same components."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for _, part in pdf.groupby(["key", "x", "y"], sort=False):
            sets = [np.frombuffer(g, np.uint64) for g in part["grams"]]
            node, label = part["node"].to_numpy(), part["label"].to_numpy()
            for i, partners in _candidates(part, distance, plan):
                if len(partners):
                    found = partners[overlap_links(sets[i], [sets[j] for j in partners])]
                    _, first = np.unique(label[found], return_index=True)
                    a += [node[i]] * len(first)
                    b += node[found[first]].tolist()
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return run


# --- the join ------------------------------------------------------------------------
def _buckets(rows: DataFrame) -> DataFrame:
    """(key, pivot) of the keys that two or more nodes share; of keys with the same nodes only one."""
    h = F.xxhash64("node")
    found = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64(h, F.lit(1))).alias("y"),
        F.min("node").alias("pivot"), F.max("node").alias("high"),
    ).where("n > 1")
    return found.groupBy("n", "x", "y", "pivot", "high").agg(F.min("key").alias("key")).select("key", "pivot")


def _both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """(a, b, column of a, column of b). A node that very many pairs name is a skewed key, which Spark's adaptive joins split."""
    a, b = (table.select(F.col("node").alias(side), F.col(column).alias(f"{column}_{side}")) for side in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", f"{column}_a", f"{column}_b")


def _labels(linked: DataFrame, rounds: int = 1) -> DataFrame:
    """(node, label) of linked pairs: equal labels are in one component (mostly, not always, the other way round too).

    A label is the smallest node within ``rounds`` + 1 links."""
    ends = linked.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
    labels = ends.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label"))
    for _ in range(rounds):
        near = ends.join(labels.select(F.col("node").alias("b"), "label"), "b")
        labels = near.groupBy(F.col("a").alias("node")).agg(F.least(F.min("label"), F.col("a")).alias("label"))
    return written(labels, "labels")


def _cells(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, x, y, node, label, side): block x of a bucket's nodes outside its most common label (side 0) meets
    block y of all its nodes (side 1). Buckets of one label, or of two nodes (their star was their only pair), are left out."""
    tagged = members.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    share = tagged.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    open_ = share.groupBy("key").agg(
        F.sum("n").alias("n"), F.max("n").alias("top"), F.max_by("label", F.struct("n", "label")).alias("common"), F.count(F.lit(1)).alias("k")
    ).where("k > 1 and n > 2")
    # Blocks are dealt by hash. A cell compares BLOCK * BLOCK pairs on average: few asked nodes meet longer blocks, so that
    # they are copied less.
    asked, every = F.col("n") - F.col("top"), F.col("n")
    ys = F.ceil(F.greatest(every * F.least(asked, F.lit(BLOCK)) / BLOCK**2, every / (LONGEST * BLOCK)))
    tagged = tagged.join(open_, "key").withColumns({"xs": F.ceil(asked / BLOCK), "ys": ys, "hash": F.xxhash64("node")})
    place = lambda x, y, side: F.struct(x.alias("x"), y.alias("y"), F.lit(side).alias("side"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    asked = F.transform(upto("ys"), lambda y: place(F.pmod("hash", "xs"), y, 0))
    every = F.transform(upto("xs"), lambda x: place(x, F.pmod("hash", "ys"), 1))
    places = F.when(F.col("label") == F.col("common"), every).otherwise(F.concat(asked, every))
    return tagged.select("key", "node", "label", F.explode(places).alias("p")).select("key", "p.x", "p.y", "node", "label", "p.side")


def near_duplicates(documents: DataFrame, target_recall: float = TARGET_RECALL) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    distance = distance_for(target_recall)
    plan = chunk_plan(POSITIONS, distance)
    docs = take_columns(short_batches(documents), {"doc_id": "bigint", "text": "string"})
    docs = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    marked = written(docs.mapInArrow(_mark, "doc_id long, n_shingles long, digest binary, sig binary"), "marked")
    nodes = marked.where("doc_id is not null and n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first(F.struct("sig", F.col("n_shingles").alias("size"))).alias("sketch")
    )
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")  # numbers that stay
    sketches = nodes.select("node", "sketch")
    rows = nodes.select("node", "sketch.sig").mapInArrow(_spread(plan), "key long, node long")
    members = written(rows.join(_buckets(rows), "key").select("key", "node", "pivot"), "members")

    star = members.where("node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    star = written(_both(star, sketches, "sketch").mapInArrow(_near(distance), "a long, b long"), "star")
    wanted = members.select("node").distinct().join(nodes.select("node", "rep", "digest", "sketch.sig"), "node")
    texts = docs.join(wanted, docs["doc_id"] == wanted["rep"]).select("node", "digest", "sig", "text")
    sets = written(texts.mapInArrow(_sets, "node long, sig binary, grams binary").dropDuplicates(["node"]), "sets")
    linked = written(_both(star, sets, "grams").mapInArrow(_confirm, "a long, b long"), "linked")
    labels = _labels(linked)

    cells = written(_cells(members, labels), "cells")
    groups = max(1, -(-cells.count() // CELL_ROWS))
    group = F.when((F.col("x") == 0) & (F.col("y") == 0), F.pmod(F.xxhash64("key"), F.lit(groups)))
    cells = cells.withColumn("g", F.coalesce(group, F.xxhash64("key", "x", "y")))
    marks = written(cells.join(sketches, "node").select("*", "sketch.sig").groupBy("g").applyInPandas(
        _mark_cells(distance, plan), "key long, x long, y long, node long, label long, side int"
    ), "marks")
    n_marks = marks.count()
    if n_marks:
        group = F.pmod(F.xxhash64("key", "x", "y"), F.lit(-(-n_marks // SET_ROWS))).alias("g")
        full = marks.join(sets, "node")  # signatures and full sets in one join
        linked = linked.unionAll(full.groupBy(group).applyInPandas(_join_cells(distance, plan), "a long, b long"))
    roots = components(linked).toDF("node", "root")

    named = nodes.select("node", "rep", "digest").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(lowest, "root").select("digest", F.col("component_id").alias("found"))
    out = marked.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
