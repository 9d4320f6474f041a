"""Operator 4: exact top-k search by pivot-table elimination.

Vectors are quantised to integers floor(256 x) and ranked by integer inner product. Adding one
coordinate sqrt(M - |x|^2) to every candidate (0 to every query) turns the largest inner product
into the smallest Euclidean distance, so distances to pivots give lower bounds by the triangle
inequality. In each block, every candidate has a row of distances to the pivots; a query takes the
largest bound over the pivots, evaluates candidates in the order of these bounds and stops when no
remaining bound can reach its k-th best score. The result is exact, ties included.

Spark deals queries and candidates into blocks of bounded size by a hash of their id; a query block
meets each candidate block in one group, and the k best of every group meet in a window. Pivots are
a bounded sample (``pivots`` vectors, broadcast); nothing else leaves the executors.

Defined results: vectors that are null, empty, or hold a null or non-finite component take no part, nor do
rows without an id. Rows that repeat an id count once (the smallest vector in array order). Vectors of
different lengths are never compared. Fewer candidates than k give fewer rows; an empty table none. Scores
beyond 64 bits are held at the ends of the range.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.text import take_columns

SCALE = 256
PIVOTS = 32
BLOCK = 8192  # candidates in a block
QUERY_BLOCK = 2048
STEP = 256  # candidates evaluated between two looks at the stopping rule
LONG = np.iinfo(np.int64)


def quantised(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<bigint>, dim) of the vectors that take part, one row per id."""
    rows = take_columns(embeddings, {id_col: "bigint", vector_col: "array<double>"})
    good = F.size(vector_col) > 0
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & good & ~bad)
    v = F.transform(vector_col, lambda x: F.floor(x * float(SCALE)))
    return rows.select(F.col(id_col).alias("id"), v.alias("v"), F.size(vector_col).alias("dim"))


def _products(q: np.ndarray, x: np.ndarray, safe: bool) -> np.ndarray:
    """Exact integer inner products of one query with rows of candidates."""
    if safe:  # every sum fits a double's 53 bits
        return (x @ q).astype(np.int64)
    exact = x.astype(object) @ q.astype(object)
    return np.array([min(max(int(s), LONG.min), LONG.max) for s in exact], np.int64)


def search_block(
    qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, pivots: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """k best (query, candidate, score) of one block, and how many candidates were evaluated."""
    order = np.argsort(cid, kind="stable")  # smaller ids first among equal bounds
    cid, c = cid[order], c[order]
    qf, cf, pf = q.astype(float), c.astype(float), pivots.astype(float)
    dim = q.shape[1]
    safe = float(np.abs(qf).max()) * float(np.abs(cf).max()) * dim < 2**53
    lengths = (cf * cf).sum(1)
    most = max(float(lengths.max()), float((pf * pf).sum(1).max()))
    lift = np.sqrt(np.maximum(most - lengths, 0))
    p_lift = np.sqrt(np.maximum(most - (pf * pf).sum(1), 0))
    # The pivot table: lifted distances candidate to pivot, and query to pivot.
    square = most + most - 2 * (cf @ pf.T + lift[:, None] * p_lift[None, :])
    table = np.sqrt(np.maximum(square, 0))
    q_len = (qf * qf).sum(1)
    q_table = np.sqrt(np.maximum(q_len[:, None] + most - 2 * (qf @ pf.T), 0))
    work = cf if safe else c
    rows_q, rows_c, rows_s, seen = [], [], [], 0
    for i in range(len(qid)):
        bound = np.abs(table - q_table[i]).max(1)
        # q.x = (|q|^2 + M - d^2) / 2, so a lower bound of d bounds the score from above.
        reach = (q_len[i] + most - bound * bound) / 2
        reach += 1 + 1e-9 * (q_len[i] + most)  # beyond any rounding of the square roots
        by = np.argsort(-reach, kind="stable")
        best_s, best_i = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, STEP
        while at < len(by):
            if len(best_s) == k and reach[by[at]] < best_s[-1]:
                break
            part = by[at : at + step]
            part = part[cid[part] != qid[i]]
            s = _products(qf[i] if safe else q[i], work[part], safe)
            s, ids = np.concatenate([best_s, s]), np.concatenate([best_i, cid[part]])
            keep = np.lexsort((ids, -s))[:k] if safe else sorted(range(len(s)), key=lambda j: (-int(s[j]), ids[j]))[:k]
            best_s, best_i = s[keep], ids[keep]
            seen += len(part)
            at, step = at + step, step * 2
        rows_q.append(np.full(len(best_s), qid[i]))
        rows_c.append(best_i)
        rows_s.append(best_s)
    return np.concatenate(rows_q), np.concatenate(rows_c), np.concatenate(rows_s), seen


def _one_per_id(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, repeated ids reduced to the smallest vector."""
    v = np.array(pdf["v"].tolist(), np.int64)
    ids = pdf["id"].to_numpy(np.int64)
    order = np.lexsort((*v.T[::-1], ids))
    ids, v = ids[order], v[order]
    first = np.r_[True, ids[1:] != ids[:-1]]
    return ids[first], v[first]


def exact_top_k(
    embeddings: DataFrame,
    queries: DataFrame | None = None,
    k: int = 5,
    pivots: int = PIVOTS,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query.

    ``queries`` has the columns of ``embeddings``; by default it is every row whose id is divisible by 50.
    """
    spark = embeddings.sparkSession
    c = quantised(embeddings)
    q = c.where(F.col("id") % 50 == 0) if queries is None else quantised(queries)
    n_c, n_q = c.count(), q.count()
    c_blocks, q_blocks = max(1, -(-n_c // block)), max(1, -(-n_q // query_block))
    some = c.orderBy(F.xxhash64(F.lit("pivot"), "id"), "id").limit(pivots).collect()
    shared = spark.sparkContext.broadcast([np.array(r["v"], np.int64) for r in some])  # ``pivots`` vectors

    def cell(df: DataFrame, side: str, n: int, other: str, copies: int) -> DataFrame:
        own = F.pmod(F.xxhash64(F.lit("block"), "id"), F.lit(n).cast("long")).alias(side)
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias(other)
        return df.select("id", "v", "dim", own, every)

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            (qid, qv), (cid, cv) = _one_per_id(left), _one_per_id(right)
            pv = [p for p in shared.value if len(p) == qv.shape[1]] or [np.zeros(qv.shape[1], np.int64)]
            out["query_id"], out["vec_id"], out["score"], _ = search_block(qid, qv, cid, cv, np.array(pv), k)
        return pd.DataFrame(out, dtype="int64")

    keys = ["dim", "q_block", "c_block"]
    pairs = cell(q, "q_block", q_blocks, "c_block", c_blocks).groupBy(*keys).cogroup(
        cell(c, "c_block", c_blocks, "q_block", q_blocks).groupBy(*keys)
    )
    found = pairs.applyInPandas(run, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
