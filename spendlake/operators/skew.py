"""A join that stays even when one key holds a large part of the rows.

Where both sides of a join are shuffled for it, AQE already splits a hot partition.
It cannot when the other side was grouped by the same key before, since that side
then has no shuffle of its own. Such joins go through ``spread_join``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is heavy when it has more than one in so many rows; so there are fewer heavy keys than this.
# The more partitions a shuffle has, the smaller the part of the rows that one should take.
HEAVY_KEYS = 1000


def heavy_limit(frame: DataFrame) -> int:
    """HEAVY_KEYS, or twice the session's shuffle partitions where that is more."""
    return max(HEAVY_KEYS, 2 * int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _share(frame: DataFrame) -> int:
    """Rows of a heavy key are spread so that a route has about one in this many of all rows."""
    return 4 * heavy_limit(frame)


def heavy_keys(sizes: DataFrame, key: str, rows: str) -> DataFrame:
    """Heavy keys and the number of routes each is spread over, from ``(key, rows)`` counts.

    Each heavy key has more than one in ``heavy_limit`` of the rows, so the result has fewer
    rows than that, and all routes together are fewer than five times as many.
    """
    total = sizes.agg(F.sum(rows)).scalar()
    heavy = sizes.filter(F.col(rows) * heavy_limit(sizes) > total)
    return heavy.select(key, F.ceil(F.col(rows) * _share(sizes) / total).alias("routes"))


def spread_join(
    facts: DataFrame, other: DataFrame, key: str, sizes: DataFrame, rows: str, spread_by: Column, how: str = "inner"
) -> DataFrame:
    """``facts`` joined to ``other`` on ``key``; ``sizes`` counts the facts per key.

    Facts of a heavy key are dealt over its routes by a hash of ``spread_by`` and the
    other side's rows of that key are copied to each route. Facts without a key, which
    match nothing, are dealt over all routes. ``how`` is ``inner`` or ``left``.
    """
    heavy = F.broadcast(heavy_keys(sizes, key, rows))
    routes = F.coalesce("routes", F.lit(1))
    ways = F.when(F.col(key).isNull(), _share(facts)).otherwise(routes)
    dealt = facts.join(heavy, key, "left").withColumn("route", F.pmod(F.xxhash64(spread_by), ways))
    copied = other.join(heavy, key, "left").withColumn("route", F.explode(F.sequence(F.lit(0), routes - 1)))
    values = [name for name in other.columns if name != key]
    joined = dealt.drop("routes").join(copied.select(key, "route", *values), [key, "route"], how)
    return joined.select(*facts.columns, *values)
