"""Typed table scans (S3) and adapters from the driver's parquet tables.

Each adapter selects only the columns it needs before any join so Parquet
column pruning and filter pushdown reach the scan.

Mapping (driver tables -> data model):

* ratings  = orders JOIN lineitem on orderkey: userId = o_custkey,
  productId = l_partkey, score = ceil(l_quantity / 10), timestamp = epoch s of o_orderdate
* products = part: name = p_name, categories = p_type,
  tags = words of p_name, p_brand, p_type joined by '|', imageUrl = null
* users    = customer: userId = c_custkey, username = c_name
* rating events = events of type view/click/purchase: productId = props.k,
  score = half_star(event_id % 10 + 1), timestamp = epoch s of ts, seq = event_id
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.functions import scalar as S

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Event types that are product ratings in the event log.
RATING_EVENT_TYPES = ("view", "click", "purchase")


def read_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One reader for every stored table; the storage format is configuration."""
    path = f"{base.rstrip('/')}/{name}"
    if fmt == "parquet" and not name.endswith(".parquet"):
        path += ".parquet"
    return spark.read.format(fmt).load(path)


def _epoch(df: DataFrame, c: str):
    return S.epoch_seconds(F.col(c), df.schema[c].dataType)


def ratings(spark: SparkSession, base: str, of_users: DataFrame | None = None) -> DataFrame:
    """Stored ratings (userId, productId, score, timestamp); with ``of_users`` (userId) those of these users only, so that
    other users' orders never reach the join with their lines."""
    orders = read_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if of_users is not None:
        wanted = of_users.select(F.col("userId").alias("wanted_user")).distinct()
        orders = orders.join(wanted, F.col("o_custkey").cast("int") == F.col("wanted_user"), "left_semi")
    lines = read_table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("productId"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("score"),
        _epoch(orders, "o_orderdate").alias("timestamp"),
    )


def products(spark: SparkSession, base: str) -> DataFrame:
    part = read_table(spark, base, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return part.select(
        F.col("p_partkey").cast("int").alias("productId"),
        F.col("p_name").alias("name"),
        F.lit(None).cast("string").alias("imageUrl"),
        F.col("p_type").alias("categories"),
        F.concat_ws(S.TAG_SEPARATOR, F.split(F.col("p_name"), " "), F.col("p_brand"), F.col("p_type")).alias(
            "tags"
        ),
    )


def users(spark: SparkSession, base: str) -> DataFrame:
    cust = read_table(spark, base, "customer").select("c_custkey", "c_name")
    return cust.select(
        F.col("c_custkey").cast("int").alias("userId"),
        F.col("c_name").alias("username"),
        F.lit(False).alias("first"),
        F.lit(None).cast("long").alias("timestamp"),
        F.array().cast(T.ArrayType(T.StringType())).alias("prefGenres"),
    )


def rating_events(spark: SparkSession, base: str) -> DataFrame:
    """Rating requests from the event log: (userId, productId, score, timestamp, seq)."""
    ev = read_table(spark, base, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return ev.where(F.col("event_type").isin(*RATING_EVENT_TYPES)).select(
        F.col("user_id").cast("int").alias("userId"),
        F.get_json_object("props", "$.k").cast("int").alias("productId"),
        S.half_star(F.col("event_id") % 10 + 1).alias("score"),
        _epoch(ev, "ts").alias("timestamp"),
        F.col("event_id").cast("long").alias("seq"),
    )


def rating_history(spark: SparkSession, base: str, of_users: DataFrame | None = None) -> DataFrame:
    """Stored ratings plus rating events, with an arrival sequence (-1 for stored rows); of some users only, if given."""
    stored = ratings(spark, base, of_users).withColumn("seq", F.lit(-1).cast("long"))
    return stored.unionByName(rating_events(spark, base))


def log_lines(spark: SparkSession, base: str) -> DataFrame:
    """Application log text derived from the event log (one ``value`` per line).

    Rating events carry the marker followed by the rating message; every other
    event becomes a noise line without the marker.
    """
    ev = read_table(spark, base, "events").select("event_id", "ts", "user_id", "event_type", "props", "value")
    ts = _epoch(ev, "ts")
    is_rating = F.col("event_type").isin(*RATING_EVENT_TYPES)
    msg = S.format_message(
        F.col("user_id").cast("int"),
        F.get_json_object("props", "$.k").cast("int"),
        S.half_star(F.col("event_id") % 10 + 1),
        ts,
    )
    # The bracketed number is the line's arrival sequence (a log offset).
    head = F.concat(ts.cast("string"), F.lit(" ["), F.col("event_id").cast("string"), F.lit("]"))
    rating_line = F.concat(head, F.lit(" INFO rest - "), F.lit(S.RATING_LOG_MARKER), msg)
    noise_line = F.concat(
        head,
        F.lit(" WARN events - "),
        F.col("event_type"),
        F.lit(" user="),
        F.col("user_id").cast("string"),
    )
    return ev.select(
        F.col("event_id").cast("long").alias("event_id"),
        F.when(is_rating, rating_line).otherwise(noise_line).alias("value"),
    )
