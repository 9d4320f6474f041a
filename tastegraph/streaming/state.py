"""Keyed streaming state (R3, R5, R7) on the RocksDB state store, of aggregations and ``transformWithState``.

* ``latest_ratings`` (R7): a streaming aggregation, per (user, product) the newest rating and how many there were. Its
  state is the upserted table: one row a key after every batch, read by ``read_latest_ratings``.
* ``UserHistory`` (R3, R5): per user a list state with the newest ratings (the bounded queue), map states of every product the
  user has rated, and a value state with the newest event and its product's neighbours. A
  micro-batch touches the state of its own users only; no stored history is read again.

Stored ratings enter once: as initial state of the first batch, a row for each ``CHUNK`` of a user's products, or as rows of the
first batch (R7). Updates are ordered by (timestamp, arrival), not by
arrival in a batch, so the outcome does not depend on how rows are dealt to batches. RocksDB keeps state on the executors'
disks and its changelog in the stream's checkpoint folder, which survives lost executors and restarts.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import islice

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tastegraph.operators import topk
from tastegraph.operators.ratings import QUEUE_CAPACITY, latest_scores
from tastegraph.operators.realtime import CANDIDATE_LIMIT

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
ITEM = "productId int, score double, timestamp long, seq long"
CHUNK = 1_000  # stored ratings of a user that are one row of the initial state, on average


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The state store's settings while a stream is started; a running stream keeps its own copy of them."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- R7: the newest rating of every user and product --------------------------------
def latest_ratings(ratings: DataFrame, stored: DataFrame) -> DataFrame:
    """Streaming (userId, productId, newest, versions, events) of the keys that a batch touches; ``newest`` is a rating
    (timestamp, seq, score), ``events`` the number of ratings that were not ``stored`` (a stream, too)."""
    cols = ["userId", "productId", "timestamp", "seq", "score", "versions", "events"]
    one = {"versions": F.lit(1).cast("long"), "events": F.lit(1)}
    rows = stored.withColumn("events", F.lit(None).cast("int")).select(*cols).unionByName(ratings.withColumns(one).select(*cols))
    return rows.groupBy("userId", "productId").agg(
        F.max(F.struct("timestamp", "seq", "score")).alias("newest"), F.sum("versions").alias("versions"), F.count("events").alias("events")
    )


def read_latest_ratings(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(userId, productId, newest, versions) of ``latest_ratings`` as of the stream's last batch."""
    with state_store(spark):
        rows = spark.read.format("statestore").load(checkpoint)
    return rows.select("key.*", F.col("value.max").alias("newest"), F.col("value.sum").alias("versions"))  # the aggregates' buffers


# --- R3 and R5: a user's queue, rated products and newest event -----------------------
def neighbour_lists(sims: DataFrame) -> DataFrame:
    """(productId, others, sims): each stored list (of bounded length) as arrays, best first."""
    order = F.array_sort(F.collect_list(F.struct(topk.rank_key("sim").alias("k"), F.col("otherId").cast("int").alias("otherId"), "sim")))
    lists = sims.groupBy("productId").agg(order.alias("l"))
    return lists.select("productId", F.col("l.otherId").alias("others"), F.col("l.sim").alias("sims"))


def stored_chunks(stored: DataFrame, item: str | Column, capacity: int = 0) -> DataFrame:
    """(userId, chunks, chunk, items): stored ratings dealt by product into chunks of about ``CHUNK`` rows, of which
    ``items`` keeps ``item``; with a capacity also ``queue``, the newest of each chunk's rows as (productId, score, timestamp, seq)."""
    n = F.ceil(F.count(F.lit(1)).over(Window.partitionBy("userId")) / CHUNK).cast("int")
    dealt = stored.withColumn("chunks", n).withColumn("chunk", F.pmod(F.coalesce("productId", F.lit(0)), F.col("chunks")))
    aggs = [F.collect_list(item).alias("items")]
    if capacity:
        newest = F.sort_array(F.collect_list(F.struct("timestamp", "seq", "productId", "score")), asc=False)
        queue = F.transform(F.slice(newest, 1, capacity), lambda r: F.struct(r.productId, r.score, r.timestamp, r.seq))
        aggs.append(queue.alias("queue"))
    return dealt.groupBy("userId", "chunks", "chunk").agg(*aggs)


class UserHistory(StatefulProcessor):
    """A user's newest ``capacity`` ratings, rated products, and newest event with the best unrated neighbours of its product."""

    STORED = "items array<int>"  # a chunk of the products that the user starts with

    def __init__(self, capacity: int = QUEUE_CAPACITY, limit: int = CANDIDATE_LIMIT):
        self.capacity, self.limit = capacity, limit

    def init(self, handle) -> None:
        self.recents = handle.getListState("recents", ITEM)
        self.rated = handle.getMapState("rated", "productId int", "known boolean")
        self.chunks = handle.getValueState("chunks", "n int")
        self.stored = handle.getMapState("stored", "chunk int", self.STORED)
        self.newest = handle.getValueState("newest", f"{ITEM}, others array<int>, sims array<double>")

    def _note(self, r: Row) -> None:
        self.rated.updateValue((r.productId,), (True,))

    def _stored(self) -> Callable[[int | None], list]:
        """The stored chunk of a product of the current user; each chunk is read once."""
        n, read = (self.chunks.get()[0] if self.chunks.exists() else 0), {}

        def of(product: int | None) -> list:
            if not n:
                return []
            c = (product or 0) % n
            if c not in read:
                found = self.stored.getValue((c,))
                read[c] = list(found[0]) if found is not None else []
            return read[c]

        return of

    def _merge(self, rows: Iterator[Row]) -> list[tuple]:
        """The queue after ``rows``; never more than the queue and one row is held."""
        best = tuple(self.newest.get()) if self.newest.exists() else None

        def items() -> Iterator[tuple]:
            nonlocal best
            yield from (tuple(r) for r in self.recents.get())
            for r in rows:
                self._note(r)
                if best is None or (r.timestamp, r.seq) > (best[2], best[3]):
                    best = (r.productId, r.score, r.timestamp, r.seq, list(r.others or []), list(r.sims or []))
                yield r.productId, r.score, r.timestamp, r.seq

        queue = heapq.nlargest(self.capacity, items(), key=lambda i: (i[2], i[3], i[0], i[1]))
        self.recents.put(queue)
        if best is not None:
            self.newest.update(best)
        return queue

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.chunks.update((initialState.chunks,))
        self.stored.updateValue((initialState.chunk,), (list(initialState.items),))
        start = [tuple(r.values()) for r in initialState.queue]  # structs within a row come as dicts
        if initialState.chunks > 1:
            start += [tuple(r) for r in self.recents.get()]
            start = heapq.nlargest(self.capacity, start, key=lambda i: (i[2], i[3], i[0], i[1]))
        self.recents.put(start)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        queue, stored = self._merge(rows), self._stored()
        product, score, timestamp, seq, others, sims = self.newest.get()
        unrated = (n for n in zip(others, sims) if n[0] not in stored(n[0]) and not self.rated.containsKey((n[0],)))
        open_ = list(islice(unrated, self.limit))
        yield Row(
            userId=key[0], productId=product, score=score, timestamp=timestamp, seq=seq,
            queue=[(i[0], i[1]) for i in queue], candidates=open_,
        )

    def close(self) -> None:
        pass


def user_history(
    ratings: DataFrame, lists: DataFrame | None = None, stored: DataFrame | None = None,
    capacity: int = QUEUE_CAPACITY, limit: int = CANDIDATE_LIMIT,
) -> DataFrame:
    """Streaming (userId, newest event, queue, candidates) of the users that a batch touches.

    ``lists`` are stored neighbour lists (productId, others, sims); ``stored`` the ratings that users start with.
    """
    if lists is None:
        events = ratings.withColumns({"others": F.lit(None).cast("array<int>"), "sims": F.lit(None).cast("array<double>")})
    else:
        events = ratings.join(lists, "productId", "left")
    start = {}
    if stored is not None:
        rows = stored.select("userId", "productId", "score", "timestamp", F.lit(-1).cast("long").alias("seq"))
        start = {"initialState": stored_chunks(rows, "productId", capacity).groupBy("userId")}
    return events.select("userId", "productId", "score", "timestamp", "seq", "others", "sims").groupBy("userId").transformWithState(
        UserHistory(capacity, limit),
        f"userId int, {ITEM}, queue array<struct<productId:int,score:double>>, candidates array<struct<productId:int,sim:double>>",
        "Update",
        "None",
        **start,
    )


# --- Q7: all that one rating changes ----------------------------------------------------
class RatedUser(UserHistory):
    """``UserHistory`` that also holds the newest rating of each product, as ``latest_ratings`` does."""

    STORED = "items array<struct<productId:int,score:double,timestamp:long,versions:long>>"

    def init(self, handle) -> None:
        super().init(handle)
        self.latest = handle.getMapState("latest", "productId int", "score double, timestamp long, seq long, versions long")
        self.touched, self.requests = {}, []

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.chunks.update((initialState.chunks,))
        self.stored.updateValue((initialState.chunk,), ([tuple(r.values()) for r in initialState.items],))

    def _note(self, r: Row) -> None:
        super()._note(r)
        now = self.latest.getValue((r.productId,))
        if now is None:  # the first request for it: the stored rating, if any, has arrived before all requests
            now = next(((i[1], i[2], -1, i[3]) for i in self.start(r.productId) if i[0] == r.productId), None)
        own, versions = (r.timestamp, r.seq, r.score), r.versions
        if now is not None:
            own, versions = max(own, (now[1], now[2], now[0])), versions + now[3]
        self.latest.updateValue((r.productId,), (own[2], own[0], own[1], versions))
        self.touched[r.productId] = (r.productId, own[2], own[0], versions)
        self.requests.append((r.productId, r.score, r.timestamp, r.seq))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        self.touched, self.requests, self.start = {}, [], self._stored()
        queue = self._merge(rows)
        yield Row(
            userId=key[0], queue=[(i[0], i[1]) for i in queue], ratings=list(self.touched.values()), requests=self.requests
        )


def rated_users(ratings: DataFrame, stored: DataFrame, capacity: int = QUEUE_CAPACITY) -> DataFrame:
    """Streaming (userId, queue, ratings, requests): the queue of each user of a batch, the newest rating of each product
    it names, and the batch's requests.

    Queues start empty, as they hold requests only; newest ratings start with the stored ones."""
    cols = ["userId", "productId", "score", "timestamp", "seq", "versions", "others", "sims"]
    none = {"others": F.lit(None).cast("array<int>"), "sims": F.lit(None).cast("array<double>")}
    start = latest_scores(stored.withColumn("seq", F.lit(-1).cast("long"))).withColumn("seq", F.lit(-1).cast("long"))
    return ratings.withColumns({"versions": F.lit(1).cast("long"), **none}).select(*cols).groupBy("userId").transformWithState(
        RatedUser(capacity),
        "userId int, queue array<struct<productId:int,score:double>>, "
        "ratings array<struct<productId:int,score:double,timestamp:long,versions:long>>, "
        "requests array<struct<productId:int,score:double,timestamp:long,seq:long>>",
        "Update",
        "None",
        initialState=stored_chunks(start, F.struct("productId", "score", "timestamp", "versions")).groupBy("userId"),
    )
