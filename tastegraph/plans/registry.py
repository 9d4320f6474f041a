"""The named query register: ``queries()`` and ``oracle_sql()`` for the driver.

Every query reads the whole driver tables under ``sf_dir`` (or data Spark
derives from them) and returns a DataFrame with explicitly aliased, explicitly
typed columns; doubles are rounded to 6 places to match the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.functions.scalar import round6
from tastegraph.operators import stats
from tastegraph.plans import oracle_sql as Q
from tastegraph.sources import tables

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


def r6(c):
    return round6(c)


# --- typed scans ------------------------------------------------------------
@register("ratings_typed", Q.RATINGS_TYPED)
def q_ratings_typed(spark, sf_dir):
    return tables.ratings(spark, sf_dir)


@register("products_typed", Q.PRODUCTS_TYPED)
def q_products_typed(spark, sf_dir):
    return tables.products(spark, sf_dir)


# --- statistics ---------------------------------------------------------------
@register("rate_more_products", Q.RATE_MORE_PRODUCTS)
def q_rate_more_products(spark, sf_dir):
    return stats.sort_by_count(stats.rate_more_products(tables.ratings(spark, sf_dir)))


@register("rate_more_recently_products", Q.RATE_MORE_RECENTLY_PRODUCTS)
def q_rate_more_recently_products(spark, sf_dir):
    return stats.sort_recent(stats.rate_more_recently_products(tables.ratings(spark, sf_dir)))


@register("average_products", Q.AVERAGE_PRODUCTS)
def q_average_products(spark, sf_dir):
    avgs = stats.average_products(tables.ratings(spark, sf_dir))
    return stats.sort_by_average(avgs.select("productId", r6("avg").alias("avg")))


@register("distinct_users_products", Q.DISTINCT_USERS_PRODUCTS)
def q_distinct_users_products(spark, sf_dir):
    return stats.distinct_ids(tables.ratings(spark, sf_dir))


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


def _load_all() -> None:
    """Import the modules that register further queries."""
    import tastegraph.plans.registry_more  # noqa: F401
