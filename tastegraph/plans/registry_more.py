"""Further registered queries (similarity, ALS, real-time, serving, streams)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegraph.functions.scalar import round6

from tastegraph.operators import itemcf, topk
from tastegraph.session import cut_lineage
from tastegraph.plans import oracle_sql as Q
from tastegraph.plans.registry import register
from tastegraph.sources import tables


# --- ItemCF -------------------------------------------------------------------
@register("cooccurrence_counts", Q.COOCCURRENCE_COUNTS)
def q_cooccurrence_counts(spark, sf_dir):
    return itemcf.cooccurrence(tables.ratings(spark, sf_dir))


@register("itemcf_top10", Q.ITEMCF_TOP10)
def q_itemcf_top10(spark, sf_dir):
    return itemcf.itemcf_top(tables.ratings(spark, sf_dir), k=10)


@register("itemcf_recs_array", Q.ITEMCF_RECS_ARRAY)
def q_itemcf_recs_array(spark, sf_dir):
    lists = itemcf.itemcf_recs(tables.ratings(spark, sf_dir), k=10)
    return topk.explode_ranked(lists, "productId", item_name="otherId", outer=True)


# --- content-based -------------------------------------------------------------
from tastegraph.operators import content  # noqa: E402


@register("content_similar_exact", Q.CONTENT_SIMILAR_EXACT)
def q_content_similar_exact(spark, sf_dir):
    return content.content_similar(tables.products(spark, sf_dir), variant="exact")


@register("content_similar_documents", Q.CONTENT_SIMILAR_DOCUMENTS)
def q_content_similar_documents(spark, sf_dir):
    """M8 over whole document texts (long vectors)."""
    docs = tables.read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("int").alias("productId"), F.col("text").alias("tags")
    )
    return content.content_similar(docs, variant="exact")


@register("content_similar_hashed", Q.CONTENT_SIMILAR_HASHED)
def q_content_similar_hashed(spark, sf_dir):
    return content.content_similar(tables.products(spark, sf_dir), variant="hashed")


# --- ALS ----------------------------------------------------------------------
from tastegraph.operators import factors, tuning  # noqa: E402


def _als_model(spark, sf_dir):
    """The default model, fitted anew from the ratings as they are."""
    return factors.fit_als(tables.ratings(spark, sf_dir))


@register("als_user_recs")
def q_als_user_recs(spark, sf_dir):
    return factors.user_recs(_als_model(spark, sf_dir), k=factors.USER_LIST_SIZE)


@register("als_residuals", Q.ALS_RESIDUALS)
def q_als_residuals(spark, sf_dir):
    """M1's proof: the factors of every rated user and product solve their normal equations."""
    ratings = tables.ratings(spark, sf_dir)
    got = factors.normal_residuals(factors.fit_als(ratings), ratings)
    bound = F.when(F.col("kind") == "user", factors.USER_RESIDUAL).otherwise(factors.PRODUCT_RESIDUAL)
    return got.select("kind", "id", "n", (F.col("residual") <= bound).alias("solved"))


@register("als_item_similar")
def q_als_item_similar(spark, sf_dir):
    return factors.item_similar(_als_model(spark, sf_dir))


@register("als_grid")
def q_als_grid(spark, sf_dir):
    return tuning.als_grid(tables.ratings(spark, sf_dir))


@register("als_rmse")
def q_als_rmse(spark, sf_dir):
    return tuning.als_rmse(tables.ratings(spark, sf_dir)).select(
        round6("rmse").alias("rmse"), F.col("n").cast("long").alias("n")
    )


@register("rmse_of_mean_predictor", Q.RMSE_OF_MEAN_PREDICTOR)
def q_rmse_of_mean_predictor(spark, sf_dir):
    r = tables.ratings(spark, sf_dir)
    return tuning.rmse(r, tuning.mean_predictor(r)).select(
        round6("rmse").alias("rmse"), F.col("n").cast("long").alias("n")
    )


# --- rating history and real-time scoring ------------------------------------------
from tastegraph.functions import scalar as S  # noqa: E402
from tastegraph.operators import ratings as R  # noqa: E402
from tastegraph.operators import realtime  # noqa: E402

# The real-time query scores against ItemCF top-20 lists; co-occurrence
# similarities are small (they peak near 0.26 at sf0.01), so this input uses a
# 0.05 cut while 0.4 stays the default for factor-based lists.
REALTIME_SIM_LIST = 20
REALTIME_ITEMCF_THRESHOLD = Q.REALTIME_ITEMCF_THRESHOLD


@register("recent_k", Q.RECENT_K)
def q_recent_k(spark, sf_dir):
    return R.recent_k(tables.rating_history(spark, sf_dir), R.RECENT_K)


@register("queue_items", Q.QUEUE_ITEMS)
def q_queue_items(spark, sf_dir):
    return R.queue_items(tables.rating_events(spark, sf_dir), R.QUEUE_CAPACITY)


@register("rating_latest", Q.RATING_LATEST)
def q_rating_latest(spark, sf_dir):
    return R.latest_scores(tables.rating_history(spark, sf_dir))


@register("rating_exists", Q.RATING_EXISTS)
def q_rating_exists(spark, sf_dir):
    return R.rating_exists(tables.rating_events(spark, sf_dir), tables.ratings(spark, sf_dir))


@register("score_normalised", Q.SCORE_NORMALISED)
def q_score_normalised(spark, sf_dir):
    ev = tables.read_table(spark, sf_dir, "events").select("event_id")
    raw = (F.col("event_id") % 10 + 1).cast("int")
    return ev.select(F.col("event_id").cast("long"), raw.alias("raw"), S.half_star(raw).alias("score"))


def itemcf_sims(spark, sf_dir, k: int = REALTIME_SIM_LIST):
    """Stored-list view of ItemCF: edge table (productId, otherId, sim) of the top-k lists.

    Materialised once (reliable checkpoint), as the stored list table the
    stream reads: the scorer looks it up twice (candidates and scoring)."""
    top = itemcf.itemcf_top(tables.ratings(spark, sf_dir), k=k)
    return cut_lineage(top.select("productId", "otherId", F.col("score").alias("sim")))


@register("candidates", Q.CANDIDATES)
def q_candidates(spark, sf_dir):
    trig = realtime.newest_event_per_user(tables.rating_events(spark, sf_dir))
    hist = tables.rating_history(spark, sf_dir, of_users=trig)
    return realtime.candidates(trig, itemcf_sims(spark, sf_dir), hist).select(
        "userId", "rank", "productId", round6("sim").alias("sim")
    )


@register("realtime_scores", Q.REALTIME_SCORES)
def q_realtime_scores(spark, sf_dir):
    trig = realtime.newest_event_per_user(tables.rating_events(spark, sf_dir))
    hist = tables.rating_history(spark, sf_dir, of_users=trig)
    return realtime.recommend(trig, itemcf_sims(spark, sf_dir), hist, threshold=REALTIME_ITEMCF_THRESHOLD)


@register("timestamps_in_seconds", Q.TIMESTAMPS_IN_SECONDS)
def q_timestamps_in_seconds(spark, sf_dir):
    """epoch values of which every other one is in milliseconds."""
    events = tables.rating_events(spark, sf_dir)
    raw = F.when(F.col("seq") % 2 == 0, F.col("timestamp") * 1000 + F.col("seq") % 1000).otherwise(F.col("timestamp"))
    return events.select("seq", raw.alias("raw")).select("seq", "raw", S.seconds("raw").alias("timestamp"))


@register("itemcf_recs_map", Q.ITEMCF_RECS_MAP)
def q_itemcf_recs_map(spark, sf_dir):
    """stored lists as maps, looked up for every rated pair of products of a user's newest two ratings."""
    lists = itemcf.itemcf_recs(tables.ratings(spark, sf_dir), k=10).select("productId", S.recs_to_map("recs").alias("sims"))
    newest = R.recent_k(tables.rating_history(spark, sf_dir), 2).groupBy("userId").agg(
        F.max_by("productId", -F.col("pos")).alias("productId"), F.max_by("productId", "pos").alias("otherId")
    )
    return newest.join(lists, "productId").select("userId", "productId", "otherId", F.col("sims")[F.col("otherId")].alias("sim"))


# --- served queries -------------------------------------------------------------
from tastegraph.operators import stats  # noqa: E402
from tastegraph.plans import serving  # noqa: E402

SERVED_N = 20


def _catalogue(spark, sf_dir):
    r = tables.ratings(spark, sf_dir)
    return r, tables.products(spark, sf_dir), stats.average_products(r)


@register("served_rate_more", Q.SERVED_RATE_MORE)
def q_served_rate_more(spark, sf_dir):
    r, p, a = _catalogue(spark, sf_dir)
    return serving.hydrate(serving.most_rated(stats.rate_more_products(r), SERVED_N), p, a, "list")


@register("served_hot", Q.SERVED_HOT)
def q_served_hot(spark, sf_dir):
    r, p, a = _catalogue(spark, sf_dir)
    return serving.hydrate(serving.hot(stats.rate_more_recently_products(r), SERVED_N), p, a, "list")


@register("served_itemcf", Q.SERVED_ITEMCF)
def q_served_itemcf(spark, sf_dir):
    r, p, a = _catalogue(spark, sf_dir)
    return serving.hydrate(serving.product_lists(itemcf.itemcf_top(r, k=10)), p, a, "sourceId")


@register("served_content", Q.SERVED_CONTENT)
def q_served_content(spark, sf_dir):
    r, p, a = _catalogue(spark, sf_dir)
    return serving.hydrated_product_lists(content.content_similar(p, "exact", info=serving.neighbour_info(p, a)))


@register("served_stream", Q.SERVED_STREAM)
def q_served_stream(spark, sf_dir):
    r, p, a = _catalogue(spark, sf_dir)
    recs = q_realtime_scores(spark, sf_dir)
    users = tables.users(spark, sf_dir)
    lists = serving.resolve_users(users.select("username"), users).join(recs, "userId")
    out = serving.hydrate(serving.user_lists(lists.select("userId", "rank", "productId", "score")), p, a, "userId")
    return serving.resolve_users(users.select("username"), users).join(out, "userId").select(
        "username", *out.columns
    )


@register("served_offline")
def q_served_offline(spark, sf_dir):
    r, p, a = _catalogue(spark, sf_dir)
    users = tables.users(spark, sf_dir)
    recs = q_als_user_recs(spark, sf_dir)
    out = serving.hydrate(serving.user_lists(recs), p, a, "userId")
    return serving.resolve_users(users.select("username"), users).join(out, "userId").select(
        "username", *out.columns
    )


@register("product_info", Q.PRODUCT_INFO)
def q_product_info(spark, sf_dir):
    r, p, a = _catalogue(spark, sf_dir)
    return serving.product_info(p, a)


@register("product_search", Q.PRODUCT_SEARCH)
def q_product_search(spark, sf_dir):
    r, p, a = _catalogue(spark, sf_dir)
    return serving.search(p, a, Q.SEARCH_PATTERN)


# --- logs, messages, user ids, loaders, layout ------------------------------------
from tastegraph.session import scratch_path  # noqa: E402
from tastegraph.sources import sinks, text  # noqa: E402
from tastegraph.streaming import logs  # noqa: E402

@register("log_extract", Q.LOG_MESSAGES)
def q_log_extract(spark, sf_dir):
    msgs = logs.extract_messages(tables.log_lines(spark, sf_dir))
    return msgs.where(F.col("message").isNotNull())


@register("message_parse", Q.MESSAGE_PARSE)
def q_message_parse(spark, sf_dir):
    parsed = logs.parse_messages(logs.extract_messages(tables.log_lines(spark, sf_dir)))
    return logs.good_ratings(parsed)


@register("user_ids", Q.USER_IDS)
def q_user_ids(spark, sf_dir):
    cust = tables.read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return cust.select(
        F.col("c_custkey").cast("int").alias("userId"),
        F.col("c_name").alias("username"),
        S.java_string_hash("c_name").alias("hashedId"),
    )


@register("load_products_text", Q.LOAD_PRODUCTS_TEXT)
def q_load_products_text(spark, sf_dir):
    path = scratch_path(spark, "products-text")
    text.write_products_text(tables.products(spark, sf_dir), path)
    prods, _ = text.read_products_text(spark, path, mode="failfast")
    return prods


@register("load_ratings_text", Q.LOAD_RATINGS_TEXT)
def q_load_ratings_text(spark, sf_dir):
    path = scratch_path(spark, "ratings-text")
    text.write_ratings_text(tables.ratings(spark, sf_dir), path)
    rates, _ = text.read_ratings_text(spark, path, mode="failfast")
    return rates




@register("layout_bucketed_lookup", Q.LAYOUT_BUCKETED_LOOKUP)
def q_layout_bucketed_lookup(spark, sf_dir):
    base = scratch_path(spark, "bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rt = sinks.write_bucketed(tables.ratings(spark, sf_dir), f"{base}/ratings", "userId", buckets)
    ut = sinks.write_bucketed(
        tables.users(spark, sf_dir).select("userId", "username"), f"{base}/users", "userId", buckets
    )
    # Both sides bucketed by userId with equal bucket counts: the join and the
    # aggregation reuse the bucketing, no exchange.
    j = spark.table(rt).join(spark.table(ut), "userId")
    return j.groupBy("userId", "username").agg(
        F.count(F.lit(1)).alias("n"), round6(F.avg("score")).alias("avg_score")
    )


# --- streams -------------------------------------------------------------------------
from tastegraph.streaming import queue as squeue  # noqa: E402
from tastegraph.streaming import rate as srate  # noqa: E402
from tastegraph.streaming import recs as srecs  # noqa: E402


def _event_log(spark, sf_dir, base):
    """The event log as text files, written in one job; and options by which a micro-batch takes a few of them at once."""
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lines = tables.log_lines(spark, sf_dir).repartitionByRange(n, "event_id").select("value")
    lines.write.text(f"{base}/logs")
    return f"{base}/logs", {"maxFilesPerTrigger": max(2, n // 2)}


def _event_ratings(spark, sf_dir, base):
    return logs.good_ratings(srecs.rating_stream(spark, "text", *_event_log(spark, sf_dir, base)))


@register("stream_log_filter", Q.LOG_MESSAGES)
def q_stream_log_filter(spark, sf_dir):
    base = scratch_path(spark, "stream-logfilter")
    src, options = _event_log(spark, sf_dir, base)
    q = logs.start_log_filter(spark, src, f"{base}/messages", f"{base}/quarantine", source_options=options)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/messages").select("seq", "message")


@register("stream_recent_queue", Q.STREAM_RECENT_QUEUE)
def q_stream_recent_queue(spark, sf_dir):
    base = scratch_path(spark, "stream-queue")
    q = squeue.start_queue_stream(spark, _event_ratings(spark, sf_dir, base), f"{base}/queues")
    q.awaitTermination()
    return squeue.read_queues(spark, f"{base}/queues")


@register("stream_recs", Q.REALTIME_SCORES)
def q_stream_recs(spark, sf_dir):
    base = scratch_path(spark, "stream-recs")
    itemcf_sims(spark, sf_dir).write.parquet(f"{base}/sims")
    q = srecs.start_recs_stream(
        spark,
        _event_ratings(spark, sf_dir, base),
        tables.ratings(spark, sf_dir),
        f"{base}/sims",
        f"{base}/streamrecs",
        threshold=REALTIME_ITEMCF_THRESHOLD,
    )
    q.awaitTermination()
    return srecs.read_stream_recs(spark, f"{base}/streamrecs")


@register("stream_rating_upsert", Q.RATING_LATEST)
def q_stream_rating_upsert(spark, sf_dir):
    """The stream's own table, one row a user and product."""
    base = scratch_path(spark, "stream-upsert")
    ratings = _event_ratings(spark, sf_dir, base)
    srecs.start_upsert_stream(spark, ratings, tables.ratings(spark, sf_dir), f"{base}/ckpt").awaitTermination()
    return srecs.read_latest(spark, f"{base}/ckpt")


@register("rate_product", Q.RATE_PRODUCT)
def q_rate_product(spark, sf_dir):
    """Q7 end to end: every rating event as a request; what the three sinks hold after the last transaction."""
    base = scratch_path(spark, "rate-product")
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    events = tables.rating_events(spark, sf_dir)
    events.select("userId", "productId", (F.col("seq") % 10 + 1).cast("int").alias("raw"), "timestamp", "seq").repartitionByRange(
        n, "seq"
    ).write.parquet(f"{base}/requests")
    requests = srate.request_stream(spark, "parquet", f"{base}/requests", {"maxFilesPerTrigger": max(2, n // 2)})
    srate.start_rating_desk(spark, requests, tables.ratings(spark, sf_dir), f"{base}/desk", f"{base}/ckpt").awaitTermination()
    ratings, queues, lines = srate.read_desk(spark, f"{base}/desk")
    text, none = F.lit(None).cast("string").alias("message"), F.lit(None)
    queue = queues.select("userId", F.posexplode("queue").alias("pos", "q"))
    return (
        ratings.select(F.lit("rating").alias("part"), "userId", "productId", "score", F.col("versions").alias("n"), text)
        .unionAll(queue.select(F.lit("queue"), "userId", "q.productId", "q.score", (F.col("pos") + 1).cast("long"), text))
        .unionAll(lines.select(F.lit("log"), none.cast("int"), none.cast("int"), none.cast("double"), "seq", "message"))
    )


# --- dense cosine over the given embeddings -------------------------------------------
from tastegraph.operators import similarity  # noqa: E402


@register("embedding_similar", Q.EMBEDDING_SIMILAR)
def q_embedding_similar(spark, sf_dir):
    emb = tables.read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("vec")
    )
    edges = similarity.dense_cosine_topk(emb, factors.ALS_SIM_LIST_SIZE, factors.ALS_SIM_THRESHOLD, block_rows=128)
    ranked = topk.rank_per_key(edges, "productId", "sim", "otherId", factors.ALS_SIM_LIST_SIZE)
    return ranked.select("productId", "rank", "otherId", S.round6("sim").alias("score"))


# --- mended or completed after the first round -----------------------------------------
LOOKUP_N = 5


@register("train_test_split", Q.TRAIN_TEST_SPLIT)
def q_train_test_split(spark, sf_dir):
    """M9: every rating with its side of the seeded split."""
    train, test = tuning.split(tables.ratings(spark, sf_dir))
    return train.withColumn("side", F.lit("train")).unionAll(test.withColumn("side", F.lit("test")))


@register("lookup_itemcf", Q.LOOKUP_ITEMCF)
def q_lookup_itemcf(spark, sf_dir):
    """The first n entries of stored lists, for the products of one size."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = itemcf.itemcf_top(tables.ratings(spark, sf_dir), k=10)
    stored = serving.store_lists(lists, scratch_path(spark, "itemcf-lists"), "productId", buckets)
    keys = tables.read_table(spark, sf_dir, "part").where("p_size = 1").select(F.col("p_partkey").cast("int").alias("productId"))
    return serving.lookup(spark.table(stored), keys, "productId", LOOKUP_N)


def _with_bad_rows(spark, sf_dir, path):
    """The ratings as text, every 50th user's rows also with a field lost."""
    r = tables.ratings(spark, sf_dir)
    line = F.concat_ws(",", *(F.col(c).cast("string") for c in ("userId", "productId", "score", "timestamp")))
    bad = r.where("userId % 50 = 0").select(F.concat_ws(",", "userId", F.lit(""), "score", "timestamp").alias("value"))
    r.select(line.alias("value")).unionAll(bad).write.text(path)


@register("load_ratings_quarantine", Q.LOAD_RATINGS_QUARANTINE)
def q_load_ratings_quarantine(spark, sf_dir):
    """S2 in quarantine mode: good rows, and the bad lines with their text."""
    path = scratch_path(spark, "bad-ratings")
    _with_bad_rows(spark, sf_dir, path)
    good, bad = text.read_ratings_text(spark, path, mode="quarantine")
    none = F.lit(None).cast("string").alias("line")
    return good.select("*", none).unionAll(
        bad.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in good.schema.fields), F.col("value").alias("line"))
    )
