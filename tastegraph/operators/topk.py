"""Ranked lists: top-k per key (T3, T4, T5), list collection (A6), flattening.

Ranking rule for every list (D1): score rounded to 6 places descending, then
the item id ascending, so ties at a cut are resolved the same way everywhere.
``row_number() <= k`` lets Spark plan a per-partition group limit before the
shuffle, so a key with a huge candidate set is already cut map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCORE_DIGITS = 6


def rank_key(score: str):
    """The D1 order as one integer (ascending = better): minus the score in
    millionths, rounded as ``functions.scalar.round6``. An integer sort key keeps
    the sort on the fast prefix-comparison path."""
    return (-F.floor(F.col(score) * 1e6 + 0.5 + 1e-6)).cast("long")


def rank_per_key(
    df: DataFrame,
    key: str,
    score: str,
    item: str,
    k: int | None = None,
    rank_col: str = "rank",
) -> DataFrame:
    """Add ``rank`` (1-based int) per ``key``; keep rank <= k when k is given."""
    w = Window.partitionBy(key).orderBy(rank_key(score).asc(), F.col(item).asc())
    out = df.withColumn(rank_col, F.row_number().over(w).cast("int"))
    if k is not None:
        out = out.where(F.col(rank_col) <= k)
    return out


def collect_ranked(
    ranked: DataFrame, key: str, item: str, score: str, rank_col: str = "rank", item_name: str = "productId"
) -> DataFrame:
    """(key, recs array<struct<productId, score>>) ordered by rank.

    Callers cut lists with ``rank_per_key(k=...)`` first, so each collected group
    is bounded by k (or by the catalogue for the unbounded content lists).
    """
    return ranked.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(rank_col), F.col(item), F.col(score)))),
            lambda r: F.struct(r[item].alias(item_name), r[score].alias("score")),
        ).alias("recs")
    )


def explode_ranked(lists: DataFrame, key: str, item_name: str = "productId", outer: bool = False) -> DataFrame:
    """(key, recs) -> (key, rank, item, score); ``outer`` keeps empty lists as nulls."""
    pe = F.posexplode_outer("recs") if outer else F.posexplode("recs")
    return lists.select(key, pe.alias("pos", "rec")).select(
        key,
        F.when(F.col("pos").isNotNull(), (F.col("pos") + 1).cast("int")).alias("rank"),
        F.col("rec.productId").alias(item_name),
        F.col("rec.score").alias("score"),
    )
