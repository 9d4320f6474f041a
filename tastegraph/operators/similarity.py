"""Pairwise item similarity (J2, J4, F2, F3, P4, P5) without cross joins.

Two strategies share one contract, an edge table ``(productId, otherId, sim)``
holding both directions and no self pairs:

* **Sparse** (co-occurrence, TF-IDF): items sharing a *key* (a user, an indexed term)
  are paired by an equi-join on that key. Only pairs with ``a < b`` are joined
  (half the join rows) and mirrored afterwards. Weights are summed per pair with
  map-side partial aggregation, so the shuffle carries partial sums, not join rows.
  *Hot keys* (a user who rated a large share of the catalogue, a term in a third
  of all products) are laid out as a grid: their items fall into g blocks and
  every two blocks meet in one cell, so no task pairs a whole hot group and
  an item is copied g + 1 times in all. Block counts come from an ordinary
  join with the key degrees: no limit on the number of hot keys, no forced broadcast.
* **Dense** (ALS factors): vectors lie in clusters of near direction. Each vector first meets a block of its own cluster, and
  then, as a query, only blocks of clusters that may hold a score above its k-th best there and the threshold. Queries and
  targets meet in ``applyInPandas`` groups of bounded size; matrix products yield cosines and only the top-k per
  query leave the task. A ranking window then merges cell-local lists.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.operators import topk
from tastegraph.schemas import EDGE
from tastegraph.session import cut_lineage

# Defaults sized for a large cluster; tests pass small values to make many cells.
PAIRS_PER_TASK = 2_000_000  # join rows one task may produce; a key whose pairs exceed it is split into cells
CELL_ENTRIES = 2_000_000  # vector entries that one cell of the verifying join is sent, at most on average
MOST_PAIRS = 262_144  # candidate pairs that it holds, on average
BOUND_SLACK = 1e-9  # bounds are sums of rounded doubles; pairs this close below the threshold are verified too
DENSE_BLOCK_ROWS = 2_048  # vectors per block in the dense strategy
DENSE_CLUSTERS = 256  # centres whose radii decide which blocks meet, at most
DENSE_CELL_ROWS = 16_384  # targets, and queries, that meet in one cell of the dense strategy, at most on average
SLICE_ENTRIES = 4_000_000  # scores held at once
SENT_ROWS = 100_000  # copies of queries made at once
MOST_PARTITIONS = 4_096


def key_degrees(entries: DataFrame, key: str) -> DataFrame:
    return entries.groupBy(key).agg(F.count(F.lit(1)).alias("d"))


def pair_partitions(deg: DataFrame, pairs_per_task: int) -> int:
    """Partitions for the pair join from its total work sum(d*(d-1)/2) (one small aggregate job)."""
    work = deg.agg(F.sum(F.col("d").cast("double") * (F.col("d") - 1) / 2)).first()[0] or 0.0
    floor = int(deg.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return int(max(floor, -(-work // pairs_per_task)))


def grid_sides(entries: DataFrame, key: str, item: str, weight: str, pairs_per_task: int) -> tuple[DataFrame, DataFrame]:
    """Left rows (key, i, j, a, wa) and right rows (key, i, j, b, wb) of the cells i <= j of each key's grid.

    A key of degree d gets g = ceil(d / sqrt(pairs_per_task)) blocks of items. Two items meet in the one cell
    of their two blocks, so both sides together hold d * (g + 1) rows.
    """
    side = F.ceil(F.col("d") / F.sqrt(F.lit(float(pairs_per_task)))).cast("int")
    grid = key_degrees(entries, key).select(key, side.alias("g"))
    tagged = entries.join(grid, key).withColumn("block", F.pmod(F.xxhash64(F.col(item)), F.col("g")).cast("int"))
    left = tagged.select(
        F.col(key), F.col("block").alias("i"), F.explode(F.sequence("block", F.col("g") - 1)).alias("j"),
        F.col(item).alias("a"), F.col(weight).alias("wa"),
    )
    right = tagged.select(
        F.col(key), F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"),
        F.col(item).alias("b"), F.col(weight).alias("wb"),
    )
    return left, right


def pairs_within_key(
    entries: DataFrame,
    key: str,
    item: str,
    weight: str,
    pairs_per_task: int = PAIRS_PER_TASK,
    keep_key: bool = False,
) -> DataFrame:
    """(a, b, wa, wb) for every key and every two of its items with a < b.

    Both sides are explicitly hash-partitioned on the grid cell into a number of
    partitions sized by the pair work, so the expanding join is spread over
    tasks even when its input is tiny (adaptive coalescing sizes partitions by
    input bytes, not by join output).
    """
    n_parts = pair_partitions(key_degrees(entries, key), pairs_per_task)
    cell = [key, "i", "j"]
    left, right = (s.repartition(n_parts, *cell) for s in grid_sides(entries, key, item, weight, pairs_per_task))
    met = left.join(right, cell).where((F.col("i") < F.col("j")) | (F.col("a") < F.col("b")))
    up = F.col("a") < F.col("b")
    pick = lambda x, y: F.when(up, F.col(x)).otherwise(F.col(y))
    out = [key] if keep_key else []
    return met.select(
        *out, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), pick("wa", "wb").alias("wa"), pick("wb", "wa").alias("wb")
    )


def sum_of_products(pairs: DataFrame, out: str) -> DataFrame:
    """(a, b, sum(wa * wb)) with partial aggregation before the shuffle."""
    return pairs.groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias(out))


def mirror(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Both directions of a symmetric upper-triangle edge table, in one pass (no union)."""
    rest = [c for c in edges.columns if c not in (a, b)]
    both = F.array(
        F.struct(F.col(a).alias("productId"), F.col(b).alias("otherId")),
        F.struct(F.col(b).alias("productId"), F.col(a).alias("otherId")),
    )
    return edges.select(F.explode(both).alias("_e"), *rest).select("_e.productId", "_e.otherId", *rest)


def distinct_vectors(postings: DataFrame, id_col: str = "productId") -> tuple[DataFrame, DataFrame]:
    """(id, vid) of every id with a non-zero vector, and (term, vid, w) of each different vector once; vid is its smallest id.

    Vectors are compared whole, but grouped and joined by a 128-bit digest: a digest whose vectors are not all
    equal would leave each of them on its own, which costs work and loses nothing.
    """
    nz = postings.where(F.col("w") != 0)
    sig = nz.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("term", "w"))).alias("v"))
    sig = cut_lineage(sig.select(F.col(id_col).alias("id"), "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")))
    groups = sig.groupBy("h1", "h2").agg(F.min("id").alias("first"), (F.min("v") == F.max("v")).alias("same"))
    placed = sig.join(groups, ["h1", "h2"]).withColumn("vid", F.when(F.col("same"), F.col("first")).otherwise(F.col("id")))
    members = cut_lineage(placed.select("id", "vid"))
    reps = placed.where(F.col("id") == F.col("vid")).select("vid", F.explode("v").alias("e"))
    return members, reps.select("e.term", "vid", "e.w")


def prefix_index(vectors: DataFrame, threshold: float) -> DataFrame:
    """(vid, tid, w, at, after, indexed) of vectors given as (term, vid, w), scaled to unit length.

    Terms are numbered and ordered from rare to frequent, alike for all vectors. ``at`` is the length of
    a vector's part from a term on, ``after`` without the term. Past the first term where ``at`` is no more than the
    threshold, nothing is indexed: two vectors that only share such terms have a product of at most
    ``at * 1``, so every pair above the threshold meets at an indexed term (rows with ``indexed``).
    """
    terms = vectors.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    terms = cut_lineage(terms.withColumn("tid", F.monotonically_increasing_id()))
    whole = Window.partitionBy("vid")
    from_end = whole.orderBy(F.desc("df"), F.desc("tid")).rowsBetween(Window.unboundedPreceding, 0)
    w2 = F.col("w") * F.col("w")
    rows = vectors.join(terms, "term").select("vid", "tid", "w", "df")
    rows = rows.withColumn("norm2", F.sum(w2).over(whole)).withColumn("tail2", F.sum(w2).over(from_end))
    at = F.sqrt(F.col("tail2") / F.col("norm2"))
    after = F.sqrt(F.greatest(F.col("tail2") - w2, F.lit(0.0)) / F.col("norm2"))
    unit = (F.col("w") / F.sqrt("norm2")).alias("w")
    return rows.select("vid", "tid", unit, at.alias("at"), after.alias("after"), (at > threshold - BOUND_SLACK).alias("indexed"))


def candidate_pairs(index: DataFrame, threshold: float, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """(a, b), a < b: vectors that share an indexed term and whose product may exceed the threshold.

    The first term that a pair above the threshold shares has at_a * at_b above it too, so other meetings are dropped.
    Of the meetings that are left, the product is at most their sum plus the rest's lengths after the last one.
    """
    entry = F.struct("w", "at", "after").alias("p")
    met = pairs_within_key(index.where("indexed").select("tid", "vid", entry), "tid", "vid", "p", pairs_per_task)
    met = met.where(F.col("wa.at") * F.col("wb.at") > threshold - BOUND_SLACK)
    bounds = met.groupBy("a", "b").agg(
        F.sum(F.col("wa.w") * F.col("wb.w")).alias("part"), F.min(F.col("wa.after") * F.col("wb.after")).alias("rest")
    )
    return bounds.where(F.col("part") + F.col("rest") > threshold - BOUND_SLACK).select("a", "b")


def _exact_products(key, pairs: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
    """(a, b, sim) of the pairs of one cell from the sparse vectors that it was sent."""
    if pairs.empty:
        return pd.DataFrame({"a": [], "b": [], "sim": []})
    at = {v: i for i, v in enumerate(vectors["vid"])}
    sizes = vectors["tids"].map(len).to_numpy()
    _, terms = np.unique(np.concatenate(vectors["tids"].to_list()), return_inverse=True)
    weights, ends = np.concatenate(vectors["ws"].to_list()), np.cumsum(sizes)
    dense, out = np.zeros(int(terms.max()) + 1), np.zeros(len(pairs))
    span = lambda i: slice(ends[i] - sizes[i], ends[i])
    a, b = (pairs[c].map(at).to_numpy() for c in "ab")
    order = np.argsort(a, kind="stable")
    for block in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
        own = span(a[block[0]])
        dense[terms[own]] = weights[own]
        n = sizes[b[block]]  # the partners' entries, one after the other
        stops = np.cumsum(n)
        entries = np.arange(stops[-1]) + np.repeat(ends[b[block]] - stops, n)
        out[block] = np.add.reduceat(dense[terms[entries]] * weights[entries], stops - n)
        dense[terms[own]] = 0
    return pd.DataFrame({"a": pairs["a"], "b": pairs["b"], "sim": out})


def verifying_side(pairs: int, vectors: int, entries: int, cell_entries: int = CELL_ENTRIES) -> int:
    """Rows and columns of the grid of cells in which pairs are verified; each vector is sent to twice as many cells at most.

    A cell is sent the two vectors of each of its pairs, but no more than the vectors of its row and its column: where pairs
    are many, the latter is far less and few cells do.
    """
    by_pairs = np.sqrt(2 * pairs * entries / vectors / cell_entries)
    return max(1, int(np.ceil(max(np.sqrt(pairs / MOST_PAIRS), min(by_pairs, 2 * entries / cell_entries)))))


def verified_pairs(candidates: DataFrame, index: DataFrame, cell_entries: int = CELL_ENTRIES) -> DataFrame:
    """(a, b, sim) with the exact product of each candidate pair.

    Pairs are dealt over a grid of cells by the hashes of both ids; a cell is sent each vector once, however many of
    its pairs name it, and a vector that very many pairs name is spread over a row of cells."""
    candidates = cut_lineage(candidates)
    entries, distinct = index.agg(F.count(F.lit(1)), F.approx_count_distinct("vid")).first()
    side = verifying_side(candidates.count(), max(1, distinct), max(1, entries), cell_entries)
    cell = [F.pmod(F.xxhash64(c), F.lit(side)).cast("int").alias(n) for c, n in (("a", "i"), ("b", "j"))]
    dealt = candidates.select("a", "b", *cell)
    sides = [dealt.select(F.col("i").alias("to_i"), F.col("j").alias("to_j"), F.col(c).alias("vid")).distinct() for c in "ab"]
    vectors = index.groupBy("vid").agg(F.collect_list("tid").alias("tids"), F.collect_list("w").alias("ws"))
    sent = sides[0].unionAll(sides[1]).distinct().join(vectors, "vid")
    kind = dict(candidates.dtypes)["a"]
    return dealt.groupBy("i", "j").cogroup(sent.groupBy("to_i", "to_j")).applyInPandas(_exact_products, f"a {kind}, b {kind}, sim double")


def sparse_cosine(postings: DataFrame, threshold: float = 0.4, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """(productId, otherId, sim) with a cosine above the threshold (0 or more), of vectors given as postings (term, productId, w).

    Equal vectors are compared once (``distinct_vectors``) and expanded to their products afterwards; two products with
    equal vectors have cosine 1. Between different vectors an exact prefix index finds candidates (``prefix_index``,
    ``candidate_pairs``), and only these bring their whole vectors to a second, narrow join (``verified_pairs``). Zero
    weights are dropped first, so a vector of zero norm never appears (its cosine is undefined, G10).
    """
    members, dots, selfsim = class_products(postings, threshold, pairs_per_task)
    ma = members.select(F.col("vid").alias("a"), F.col("id").alias("pa"))
    mb = members.select(F.col("vid").alias("b"), F.col("id").alias("pb"))
    cross = dots.join(ma, "a").join(mb, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"), "sim")
    twins = pairs_within_key(members.withColumn("one", F.lit(1.0)), "vid", "id", "one", pairs_per_task, keep_key=True)
    same = twins.join(selfsim, "vid").select("a", "b", "sim")
    return mirror(cross.unionByName(same))


def class_products(
    postings: DataFrame, threshold: float, pairs_per_task: int = PAIRS_PER_TASK
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, vid) of ``distinct_vectors``; (a, b, sim) of different vectors a < b, and (vid, sim) of a vector with itself, above the threshold."""
    if threshold < 0:
        raise ValueError("the prefix index needs a threshold of 0 or more")
    members, vectors = distinct_vectors(postings)
    index = cut_lineage(prefix_index(vectors, threshold))
    dots = verified_pairs(candidate_pairs(index, threshold, pairs_per_task), index).where(F.col("sim") > threshold)
    selfsim = index.groupBy("vid").agg(F.sum(F.col("w") * F.col("w")).alias("sim")).where(F.col("sim") > threshold)
    return members, dots, selfsim


def neighbour_lists(
    postings: DataFrame,
    threshold: float = 0.4,
    k: int | None = None,
    info: DataFrame | None = None,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """(productId, rank, otherId, score): the edges of ``sparse_cosine`` ranked per product (D1), the first ``k`` of each or all.

    Products with equal vectors have one list, but for themselves: it is shuffled and ranked once a vector, and each of
    its products then reads it where it lies, leaving itself out. A vector whose products' lists exceed a task's share
    has its list copied for several blocks of its products. With ``info`` (otherId, columns ...) list rows bring these
    columns along and neighbours without a row there are left out after ranking, as an inner join would.
    """
    members, dots, selfsim = class_products(postings, threshold, pairs_per_task)
    dots, selfsim = cut_lineage(dots), cut_lineage(selfsim)
    links = mirror(dots).select(F.col("productId").alias("a"), F.col("otherId").alias("b"), topk.rank_key("sim").alias("key"))
    links = links.unionByName(selfsim.select(F.col("vid").alias("a"), F.col("vid").alias("b"), topk.rank_key("sim").alias("key")))
    sizes = cut_lineage(members.groupBy(F.col("vid").alias("a")).agg(F.count(F.lit(1)).alias("n"), F.count("id").alias("known")))
    length = links.join(sizes.select(F.col("a").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").cast("double").alias("length"))
    work = cut_lineage(sizes.join(length, "a"))
    rows = work.agg(F.sum(F.col("length") * F.col("n"))).first()[0] or 0.0
    floor = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_parts = max(floor, min(MOST_PARTITIONS, int(-(-rows // pairs_per_task))))
    share = max(float(pairs_per_task), rows / MOST_PARTITIONS)
    blocks = F.least(F.ceil(F.col("length") * F.col("n") / share), F.col("n")).cast("int").alias("g")
    # A product without an id is no twin of others: it reads the list in a block of its own, without its vector's products.
    blocks = work.select("a", blocks, (F.col("n") > F.col("known")).alias("odd"))

    others = members.select(F.col("vid").alias("b"), F.col("id").alias("otherId"))
    brought = []
    if info is not None:
        brought = [c for c in info.columns if c != "otherId"]
        others = others.join(info.withColumn("found", F.lit(True)), "otherId", "left")
    block = F.explode(F.sequence(F.when(F.col("odd"), -1).otherwise(0), F.col("g") - 1)).alias("i")
    lists = links.join(blocks, "a").join(others, "b").withColumn("own", F.col("a") == F.col("b"))
    lists = lists.select("a", block, "key", "otherId", "own", *(["found", *brought] if info is not None else []))
    lists = lists.where(~F.col("own") | (F.col("otherId").isNotNull() & (F.col("i") >= 0))).repartition(n_parts, "a", "i")
    # Equal places are copies of one neighbour's row of ``info``.
    place = F.dense_rank().over(Window.partitionBy("a", "i").orderBy("key", "otherId"))
    lists = lists.withColumn("at", place)
    if k is not None:
        lists = lists.where(F.col("at") <= k + 1)

    own_key = F.when(F.col("productId").isNotNull(), topk.rank_key("sim")).alias("own_key")
    reads = F.when(F.col("productId").isNull(), -1).otherwise(F.pmod(F.xxhash64("productId"), F.col("g"))).cast("int").alias("i")
    readers = members.select(F.col("vid").alias("a"), F.col("id").alias("productId")).join(blocks, "a")
    readers = readers.join(selfsim.select(F.col("vid").alias("a"), "sim"), "a", "left").select("a", reads, "productId", own_key)
    read = lists.join(readers.repartition(n_parts, "a", "i"), ["a", "i"])
    read = read.where(~F.col("own") | (F.col("otherId") != F.col("productId")))
    after = (F.col("key") > F.col("own_key")) | ((F.col("key") == F.col("own_key")) & (F.col("otherId") > F.col("productId")))
    rank = (F.col("at") - F.when(after, 1).otherwise(0)).cast("int").alias("rank")
    score = (-F.col("key") / 1e6).alias("score")
    if info is not None:
        read = read.where("found")
    out = read.select("productId", rank, "otherId", score, *brought)
    return out if k is None else out.where(F.col("rank") <= k)


# --- dense ---------------------------------------------------------------------
def _own_block_best(k: int, threshold: float | None):
    """Rows of one block with ``reached``: the key of their k-th best within it, no more than that of their whole list."""

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        unit, ids = _unit_rows(pdf["vec"]), pdf["id"].to_numpy()
        reached = np.full(len(pdf), np.nan)
        if len(pdf) > k:
            for part in _slices(len(pdf), len(pdf)):
                keys = _score_keys(unit[part] @ unit.T, threshold)
                keys[ids[part, None] == ids[None, :]] = -np.inf
                kth = -np.partition(-keys, k - 1, axis=1)[:, k - 1]
                reached[part] = np.where(np.isfinite(kth), kth, np.nan)
        return pdf[["id", "vec", "cluster", "angle"]].assign(reached=reached)

    return fn


def _cell_topk(k: int, threshold: float | None):
    """Best targets of one cell's queries (side 0) among its targets (side 1)."""

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        queries, targets = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        outs = [pd.DataFrame({"productId": [], "otherId": [], "sim": []})]
        if len(queries) and len(targets):
            qv, tv = _unit_rows(queries["vec"]), _unit_rows(targets["vec"])
            qid, tid = queries["id"].to_numpy(), targets["id"].to_numpy()
            qc, tc = queries["cluster"].to_numpy(), targets["cluster"].to_numpy()
            reached = queries["reached"].fillna(-np.inf).to_numpy(dtype=np.float64)
            for part in _slices(len(qid), len(tid)):
                own = (qid[part, None] == tid[None, :]) & (qc[part, None] == tc[None, :])
                outs.append(_rows_topk(qv[part] @ tv.T, qid[part], tid, k, threshold, own, reached[part]))
        return pd.concat(outs[1:] or outs, ignore_index=True)

    return fn


def _slices(rows: int, columns: int) -> list[slice]:
    """Rows of a matrix in slices of at most ``SLICE_ENTRIES`` entries, or one row."""
    step = max(1, SLICE_ENTRIES // max(1, columns))
    return [slice(i, min(i + step, rows)) for i in range(0, rows, step)]


def _score_keys(sims: np.ndarray, threshold: float | None) -> np.ndarray:
    """Scores in millionths by the ranking rule of ``topk.rank_key``; -inf where not above the threshold."""
    keys = np.floor(sims * 1e6 + 0.5 + 1e-6)
    if threshold is not None:
        keys[~(sims > threshold)] = -np.inf
    return keys


def _unit_rows(vecs: pd.Series) -> np.ndarray:
    m = np.stack(vecs.to_numpy()).astype(np.float64)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _rows_topk(sims, row_ids, col_ids, k, threshold, same, reached=None):
    """Per row: entries whose 6-place rounded score reaches the row's k-th best, and what it has ``reached`` elsewhere.

    Keeping every tie at the cut makes the final (rounded score desc, id asc)
    ranking exact after cell-local lists are merged. ``same`` marks the entries of a row with itself
    (or says that equal ids are).
    """
    s = _score_keys(sims, threshold)
    if same is True:
        same = row_ids[:, None] == col_ids[None, :]
    if same is not False:
        s[same] = -np.inf
    cut = np.full(len(s), -np.inf) if reached is None else np.array(reached, np.float64)
    many = np.flatnonzero((s >= cut[:, None]).sum(1) > k)
    if len(many):
        cut[many] = np.maximum(cut[many], -np.partition(-s[many], k - 1, axis=1)[:, k - 1])
    rows, cols = np.nonzero((s >= cut[:, None]) & np.isfinite(s))
    return pd.DataFrame({"productId": row_ids[rows], "otherId": col_ids[cols], "sim": sims[rows, cols]})


@dataclass(frozen=True)
class DensePlan:
    """Which blocks of vectors meet: ``clusters`` with centre and blocks each, and the cluster pairs that are not skipped."""

    centres: np.ndarray  # unit rows
    first_block: np.ndarray
    blocks: np.ndarray
    met: list[tuple[int, int]]  # cluster pairs c <= d
    rows: np.ndarray  # vectors of each cluster
    radius: np.ndarray  # the greatest angle of a cluster's vector to its centre

    def pairs(self, clusters: list[tuple[int, int]]) -> int:
        """Block pairs (i <= j) of the cluster pairs."""
        n = self.blocks
        return int(sum(n[c] * (n[c] + 1) // 2 if c == d else n[c] * n[d] for c, d in clusters))

    @property
    def skipped(self) -> float:
        """Share of all block pairs that never meet."""
        every = self.pairs([(c, d) for c in range(len(self.blocks)) for d in range(c, len(self.blocks))])
        return 1 - self.pairs(self.met) / every if every else 0.0


def _arrays(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _assigned(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """(id, vec, cluster, angle): each vector with its nearest centre and the angle to it."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v = _arrays(batch.column(1))
                cos = (v / np.linalg.norm(v, axis=1, keepdims=True)) @ centres.T
                near = cos.argmax(1)
                angle = np.arccos(np.clip(cos[np.arange(len(v)), near], -1, 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(near.astype(np.int32)), pa.array(angle)], names=["id", "vec", "cluster", "angle"]
                )

    kinds = dict(vectors.dtypes)
    return vectors.mapInArrow(run, f"id {kinds['id']}, vec {kinds['vec']}, cluster int, angle double")


def dense_plan(vectors: DataFrame, threshold: float | None, block_rows: int, max_clusters: int = DENSE_CLUSTERS) -> tuple[DensePlan, DataFrame]:
    """The plan for non-zero vectors (id, vec), and the vectors with their ``cluster``.

    At most ``max_clusters`` centres, from rows chosen by a hash of their id, moved once to the mean of their cluster. Two
    clusters whose centres are further apart than both radii and the threshold's angle hold no pair above it.
    """
    n = vectors.count()
    some = vectors.orderBy(F.xxhash64(F.lit("centre"), "id"), "id").limit(max(1, min(max_clusters, -(-n // block_rows))))
    centres = np.array([r["vec"] for r in some.select("vec").collect()], np.float64).reshape(-1, len((vectors.first() or {"vec": [0]})["vec"]))
    if not n:
        none = np.zeros(0, int)
        return DensePlan(centres, none, none, [], none, np.zeros(0)), _assigned(vectors, centres)
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    dim = centres.shape[1]
    unit_sum = [F.sum(F.col("vec")[j].cast("double") / F.col("norm")).alias(f"s{j}") for j in range(dim)]
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    moved = _assigned(vectors, centres).withColumn("norm", norm).groupBy("cluster").agg(*unit_sum).toPandas()  # a row a centre
    mean = moved[[f"s{j}" for j in range(dim)]].to_numpy()
    length = np.linalg.norm(mean, axis=1, keepdims=True)
    centres[moved["cluster"].to_numpy()] = np.where(length > 1e-9, mean / np.maximum(length, 1e-9), centres[moved["cluster"].to_numpy()])
    placed = cut_lineage(_assigned(vectors, centres))
    stats = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).toPandas()
    rows, radius = np.zeros(len(centres), int), np.zeros(len(centres))
    rows[stats["cluster"]], radius[stats["cluster"]] = stats["n"], stats["radius"]
    blocks = -(-rows // block_rows)
    apart = np.arccos(np.clip(centres @ centres.T, -1, 1)) - radius[:, None] - radius[None, :]
    meet = np.cos(np.clip(apart, 0, np.pi)) > (-2.0 if threshold is None else threshold - 1e-6)
    met = [(c, d) for c in range(len(centres)) for d in range(c, len(centres)) if blocks[c] and blocks[d] and (c == d or meet[c, d])]
    return DensePlan(centres, np.r_[0, np.cumsum(blocks)][:-1], blocks, met, rows, radius), placed


def _chained(centres: np.ndarray) -> list[int]:
    """The centres in a chain from each to the nearest one that is left, so that neighbours in it are near."""
    left, chain = set(range(1, len(centres))), [0]
    while left:
        rest = sorted(left)
        chain.append(rest[int(np.argmax(centres[rest] @ centres[chain[-1]]))])
        left.remove(chain[-1])
    return chain


def target_blocks(plan: DensePlan, cell_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first block, number of blocks, rows of a block on average) of each cluster: blocks of about ``cell_rows`` vectors.

    Small clusters that are near each other share a block, a large one is dealt over several."""
    first, number, size = np.zeros(len(plan.rows), int), np.ones(len(plan.rows), int), []
    for c in _chained(plan.centres):
        if plan.rows[c] > cell_rows:
            first[c], number[c] = len(size), -(-plan.rows[c] // cell_rows)
            size += [plan.rows[c]] * number[c]  # closed: no cluster joins it
        else:
            if not size or size[-1] + plan.rows[c] > cell_rows:
                size.append(0)
            first[c] = len(size) - 1
            size[-1] += plan.rows[c]
    return first, number, np.array(size)


def _reachable(vec: np.ndarray, reached: np.ndarray, plan: DensePlan, threshold: float | None) -> np.ndarray:
    """Clusters (columns) that may hold a vector that enters a row's list: by angle to the centre, radius and what the row has reached."""
    cos = (vec / np.linalg.norm(vec, axis=1, keepdims=True)) @ plan.centres.T
    most = np.cos(np.clip(np.arccos(np.clip(cos, -1, 1)) - plan.radius[None, :], 0, np.pi))
    need = np.fmax((reached - 1) / 1e6, -2.0 if threshold is None else threshold)
    return ~(most < need[:, None] - 1e-6) & (plan.rows > 0)[None, :]


def _sent(rows: DataFrame, plan: DensePlan, threshold: float | None, blocks: tuple[np.ndarray, np.ndarray, np.ndarray], chunks: np.ndarray | None) -> DataFrame:
    """The blocks that each row's search needs: rows (j, s, id, vec, cluster, reached), s one of the block's ``chunks``; without them (j, n)."""
    first, number, size = blocks
    clusters = np.repeat(np.arange(len(first)), number)  # of every pair of a cluster and a block
    of = np.concatenate([np.arange(f, f + n) for f, n in zip(first, number)])

    def needed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        reached = batch.column(3).to_numpy(zero_copy_only=False).astype(np.float64)
        ok = _reachable(_arrays(batch.column(1)), reached, plan, threshold)[:, clusters]
        at, pair = np.nonzero(ok)
        pairs = np.unique(at * len(size) + of[pair])
        return pairs // len(size), pairs % len(size)

    def parts(batches):
        step = max(1, SENT_ROWS // len(size))
        for batch in batches:
            yield from (batch.slice(i, step) for i in range(0, batch.num_rows, step))

    def count(batches):
        n = np.zeros(len(size), np.int64)
        for batch in parts(batches):
            n += np.bincount(needed(batch)[1], minlength=len(size))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(size))), pa.array(n)], names=["j", "n"])

    def send(batches):
        for batch in parts(batches):
            at, j = needed(batch)
            s = batch.column(4).to_numpy()[at] % chunks[j]
            own = [batch.column(i).take(pa.array(at)) for i in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(j.astype(np.int32)), pa.array(s.astype(np.int32)), *own], names=["j", "s", *names])

    names = ["id", "vec", "cluster", "reached"]
    kinds = dict(rows.dtypes)
    given = rows.select(*names, F.pmod(F.xxhash64(F.lit("chunk"), "id"), F.lit(1 << 30)).alias("h"))
    if chunks is None:
        return given.mapInArrow(count, "j long, n long")
    return given.mapInArrow(send, f"j int, s int, id {kinds['id']}, vec {kinds['vec']}, cluster int, reached double")


def dense_cosine_topk(
    vectors: DataFrame,
    k: int,
    threshold: float | None = 0.4,
    block_rows: int = DENSE_BLOCK_ROWS,
    max_clusters: int = DENSE_CLUSTERS,
    cell_rows: int | None = None,
) -> DataFrame:
    """Top-k cosine neighbours (productId, otherId, sim) per vector over (id, vec array) without a cross join.

    Vectors lie in clusters of near direction (``dense_plan``). First each meets only some of its cluster (a block of
    about ``block_rows``): its k-th best there is a bound. Then it is sent only to those blocks of targets
    (``target_blocks``) whose clusters' centres and radii leave room for a score that reaches this bound and the threshold. Targets and
    queries meet in cells of about ``cell_rows`` each, a matrix product a slice, so without any clusters a vector is copied
    twice its number over ``cell_rows`` times. Candidates per row are at most ``k`` a cell and ties, cut by the caller's ranking window.
    """
    # Zero vectors have no cosine (NaN in the reference, dropped by its > 0.4 cut).
    unit = vectors.select("id", "vec").where(
        F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")) > 0
    )
    plan, placed = dense_plan(unit, threshold, block_rows, max_clusters)
    spark, kinds = vectors.sparkSession, dict(vectors.dtypes)
    if not plan.rows.sum():
        return spark.createDataFrame([], f"productId {kinds['id']}, otherId {kinds['id']}, sim double")
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_blocks = spark.createDataFrame([(c, int(n)) for c, n in enumerate(plan.blocks)], "cluster int, n int")
    blk = placed.join(in_blocks, "cluster").withColumn("blk", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    blk = blk.repartition(int(max(floor, min(MOST_PARTITIONS, plan.blocks.sum()))), "cluster", "blk")
    known = f"id {kinds['id']}, vec {kinds['vec']}, cluster int, angle double, reached double"
    rows = cut_lineage(blk.groupBy("cluster", "blk").applyInPandas(_own_block_best(k, threshold), known))
    cell_rows = cell_rows or min(DENSE_CELL_ROWS, max(block_rows, -(-int(plan.rows.sum()) // 8)))
    blocks = first, number, size = target_blocks(plan, cell_rows)
    met = _sent(rows, plan, threshold, blocks, None).groupBy("j").agg(F.sum("n").alias("n")).toPandas()  # a row a block
    chunks = np.ones(len(size), np.int64)
    chunks[met["j"]] = np.maximum(1, -(-met["n"] // cell_rows))
    queries = _sent(rows, plan, threshold, blocks, chunks).withColumn("side", F.lit(0))
    own = spark.createDataFrame([(c, int(first[c]), int(number[c])) for c in range(len(first))], "cluster int, first int, number int")
    spread = spark.createDataFrame([(j, int(n)) for j, n in enumerate(chunks)], "j int, chunks int")
    place = (F.col("first") + F.pmod(F.xxhash64(F.lit("target"), "id"), F.col("number"))).cast("int").alias("j")
    targets = rows.join(own, "cluster").select(place, "id", "vec", "cluster").join(spread, "j").select(
        "j", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("s"), "id", "vec", "cluster",
        F.lit(None).cast("double").alias("reached"), F.lit(1).alias("side"),
    )
    dealt = queries.unionByName(targets).repartition(int(max(floor, min(MOST_PARTITIONS, chunks.sum()))), "j", "s")
    return dealt.groupBy("j", "s").applyInPandas(_cell_topk(k, threshold), f"productId {kinds['id']}, otherId {kinds['id']}, sim double")


__all__ = [
    "EDGE",
    "dense_cosine_topk",
    "mirror",
    "pairs_within_key",
    "sparse_cosine",
    "sum_of_products",
]
