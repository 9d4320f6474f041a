"""Bounded per-user recent-rating queue of a rating stream.

The queue itself is list state (``streaming.state.UserHistory``): the newest ``capacity`` (40) ratings of a user by
(timestamp, seq, productId, score). No de-duplication by product: rating the same product twice puts it twice
(G4). State per user is bounded by the capacity, so no watermark is needed.

The output of each batch is the full queue of every user touched; ``KeyedSnapshots`` keeps the newest queue per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.operators.ratings import QUEUE_CAPACITY
from tastegraph.session import scratch_path
from tastegraph.sources.sinks import KeyedSnapshots
from tastegraph.streaming.state import state_store, user_history

COMPACT_EVERY = 50  # micro-batches between snapshot compactions


def start_queue_stream(
    spark: SparkSession,
    ratings_stream: DataFrame,
    out_dir: str,
    capacity: int = QUEUE_CAPACITY,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    compact_every: int = COMPACT_EVERY,
):
    """Run R3 into a ``KeyedSnapshots`` table keyed by userId (the queue as an array)."""
    store = KeyedSnapshots(out_dir, "userId")

    def sink(batch: DataFrame, batch_id: int) -> None:
        store.write(batch.select("userId", "queue"), batch_id)
        if batch_id and batch_id % compact_every == 0:
            store.compact(spark, batch_id)

    with state_store(spark):
        w = user_history(ratings_stream, capacity=capacity).writeStream.outputMode("update").foreachBatch(sink)
        w = w.option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-queue"))
        return w.trigger(**(trigger or {"availableNow": True})).start()


def read_queues(spark: SparkSession, out_dir: str) -> DataFrame:
    """Exploded current queues: (userId, pos, productId, score)."""
    cur = KeyedSnapshots(out_dir, "userId").current(spark)
    return cur.select("userId", F.posexplode("queue").alias("pos", "q")).select(
        "userId", (F.col("pos") + 1).alias("pos"), F.col("q.productId").alias("productId"), F.col("q.score").alias("score")
    )
