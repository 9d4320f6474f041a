"""Exact top-k inner products of two sets of vectors (J3, M2) by norm-ordered blocks.

Items are dealt into classes of falling length (a class holds lengths within a factor ``CLASS_RATIO``) and classes into
rounds that grow fourfold. In a round, blocks of users meet blocks of the round's items in cells of bounded size; a matrix
product gives the scores, products that a user has already rated are masked in the cell, and only each user's best k
(ties at the cut included) leave it. By Cauchy-Schwarz no later item scores more than |user| times the greatest
length left, so a user whose k-th score lies above that is done and takes no part in further rounds.

Ranking is the rule of ``topk`` (D1): the score rounded to 6 places, then the smaller item id; only scores
above 0 count (P3). Bounds are rounded up, so the result is that of all products, pair by pair.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.operators import topk
from tastegraph.session import cut_lineage

BLOCK_ROWS = 8_192  # users or items of one block, on average
LEAST_ROWS = 512  # users of one block, about, where more blocks only serve to occupy tasks
SLICE_ENTRIES = 4_000_000  # scores held at once
FIRST_ROUND = 4_096  # items of the first round, at least
CLASS_RATIO = 1.1
CLASSES = 64  # the last one takes every shorter item


def score_keys(scores: np.ndarray) -> np.ndarray:
    """Scores in millionths, rounded as ``topk.rank_key`` does."""
    return np.floor(scores * 1e6 + 0.5 + 1e-6)


def _cell(k: int):
    """Best items (id, other, score) of the users of one cell. ``right`` holds items and the (user, item) pairs to leave out."""

    def run(key, users: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        items, seen = right[right["user"].isna()], right[right["user"].notna()]
        if users.empty or items.empty:
            return pd.DataFrame({"id": [], "other": [], "score": []})
        u, v = (np.stack(df["vec"].to_numpy()).astype(np.float64) for df in (users, items))
        uid, vid = users["id"].to_numpy(), items["id"].to_numpy()
        row = col = np.zeros(0, int)
        if len(seen):
            row = pd.Series(np.arange(len(uid)), uid).reindex(seen["user"].to_numpy()).to_numpy()
            col = pd.Series(np.arange(len(vid)), vid).reindex(seen["id"].to_numpy()).to_numpy()
            both = ~(np.isnan(row) | np.isnan(col))
            row, col = row[both].astype(int), col[both].astype(int)
        # What rounds before have reached: anything below can't enter the user's list.
        reached = users["reached"].fillna(-np.inf).to_numpy()
        step, outs = max(1, SLICE_ENTRIES // len(vid)), []
        for at in range(0, len(uid), step):
            scores = u[at : at + step] @ v.T
            keys = score_keys(scores)
            here = (row >= at) & (row < at + step)
            keys[row[here] - at, col[here]] = -np.inf
            keys[scores <= 0] = -np.inf
            cut = reached[at : at + step]
            if keys.shape[1] > k:
                cut = np.maximum(cut, -np.partition(-keys, k - 1, axis=1)[:, k - 1])
            rows, cols = np.nonzero((keys >= cut[:, None]) & np.isfinite(keys))
            outs.append(pd.DataFrame({"id": uid[rows + at], "other": vid[cols], "score": scores[rows, cols]}))
        return pd.concat(outs, ignore_index=True)

    return run


def _rounds(sizes: list[tuple[int, int, float]]) -> list[tuple[int, int, int, float]]:
    """(first class, last class, items, greatest length) of each round, of (class, items, greatest length) in order."""
    out, goal = [], FIRST_ROUND
    for c, n, longest in sizes:
        if out and out[-1][2] < goal:
            first, _, before, top = out[-1]
            out[-1] = (first, c, before + n, top)
        else:
            goal = goal * 4 if out else goal
            out.append((c, c, n, longest))
    return out


def top_inner_products(
    users: DataFrame, items: DataFrame, k: int, exclude: DataFrame | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(id, other, score): for each user of (id, vec) the best k items of (id, vec) by inner product, above 0.

    ``exclude`` has (id, other) pairs that never enter a list. All ids are of one integer type.
    """
    kind = dict(users.dtypes)["id"]
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    items = items.select("id", "vec", length.alias("length")).where("length > 0")
    longest = items.agg(F.max("length")).first()[0]
    schema = f"id {kind}, other {kind}, score double"
    if longest is None:
        return users.sparkSession.createDataFrame([], schema)
    cls = F.least(F.floor(F.log(F.lit(longest) / F.col("length")) / float(np.log(CLASS_RATIO))), F.lit(CLASSES - 1))
    items = cut_lineage(items.withColumn("class", F.greatest(cls, F.lit(0)).cast("int")))
    sizes = items.groupBy("class").agg(F.count(F.lit(1)), F.max("length")).orderBy("class").collect()  # CLASSES rows at most
    users = cut_lineage(users.select("id", "vec", length.alias("length")).where("length > 0"))
    open_ = users.withColumn("reached", F.lit(None).cast("double"))
    cells = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best = None
    rounds = _rounds([tuple(r) for r in sizes])
    for at, (first, last, n, _) in enumerate(rounds):
        n_users = open_.count()
        if not n_users:
            break
        u_blocks, i_blocks = max(1, -(-n_users // block_rows)), max(1, -(-n // block_rows))
        u_blocks = max(u_blocks, min(-(-cells // i_blocks), -(-n_users // LEAST_ROWS)))  # enough cells for all tasks
        u_block = lambda c: F.pmod(F.xxhash64(c), F.lit(u_blocks)).cast("int").alias("i")
        i_block = lambda c: F.pmod(F.xxhash64(c), F.lit(i_blocks)).cast("int").alias("j")
        own = items.where(F.col("class").between(first, last))
        span = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = open_.select("id", "vec", "reached", u_block("id")).select("*", span(i_blocks).alias("j"))
        right = own.select("id", "vec", i_block("id"), F.lit(None).cast(kind).alias("user")).select("*", span(u_blocks).alias("i"))
        if exclude is not None:
            pairs = exclude.select(F.col("id").alias("user"), F.col("other").alias("id")).join(own.select("id"), "id")
            pairs = pairs.join(open_.select(F.col("id").alias("user")), "user")
            pairs = pairs.select("id", F.lit(None).cast(dict(own.dtypes)["vec"]).alias("vec"), i_block("id"), "user", u_block("user"))
            right = right.unionByName(pairs)
        found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(_cell(k), schema)
        best = topk.rank_per_key(found if best is None else best.unionAll(found), "id", "score", "other", k).drop("rank")
        best = cut_lineage(best)
        if at + 1 < len(rounds):
            most = rounds[at + 1][3]
            kth = best.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max(topk.rank_key("score")).alias("key"))
            kth = kth.where(F.col("n") >= k).select("id", (-F.col("key")).cast("double").alias("reached"))
            bound = F.floor(F.col("length") * most * 1e6 * (1 + 1e-9) + 1.5)
            open_ = users.join(kth, "id", "left").where(F.col("reached").isNull() | (F.col("reached") <= bound))
            open_ = cut_lineage(open_.select("id", "vec", "length", "reached"))
    return best if best is not None else users.sparkSession.createDataFrame([], schema)
