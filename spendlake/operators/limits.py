"""The first rows of every group, in any order, without sorting or numbering whole groups.

Each group's last needed value is found by counts: the values of a group are counted in cells, the cell in
which the limit is reached is counted in finer cells, and so on. What lies behind that value is dropped where it
is read, so that only about ``limit`` rows of a group are shuffled and numbered after that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.session import stored

# Cells that a range of values is counted in, per group and pass.
CELLS = 1024
# Values are cut off here, so that their differences fit a whole number; NULL lies at the end.
_END = 1 << 61


def _number(name: str, kind: T.DataType) -> tuple[Column, bool]:
    """A whole number that grows with the column, and whether different values always have different ones."""
    value = F.col(name)
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint"), True
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (value * 10**kind.scale).cast("bigint"), True
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint"), True
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name), True
    if isinstance(kind, T.TimestampNTZType):
        days = F.unix_date(value.cast("date")).cast("bigint")
        micros = (F.expr(f"extract(second from `{name}`)") * 1_000_000).cast("bigint")
        return ((days * 24 + F.hour(name)) * 60 + F.minute(name)) * 60_000_000 + micros, True
    if isinstance(kind, T.StringType):  # its first seven bytes
        return F.conv(F.rpad(F.hex(F.substring(value.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint"), False
    if isinstance(kind, T.FractionalType):
        return F.floor(value.cast("double") * (1 << 20)).cast("bigint"), False
    raise TypeError(f"no order of {kind.simpleString()} is supported")


def _place(name: str, kind: T.DataType, ascending: bool) -> tuple[Column, bool]:
    """The same, ascending with the place of the value in the wanted order: NULL first if ascending, else last."""
    number, exact = _number(name, kind)
    held = F.greatest(F.lit(1 - _END), F.least(F.lit(_END - 1), number))
    end = F.lit(-_END if ascending else _END)
    return F.when(number.isNull(), end).otherwise(held if ascending else -held), exact


def _narrowed(keyed: DataFrame, key: str, open_: DataFrame, limit: int) -> DataFrame:
    """``open_`` (of_group, room, low, high) with the range of ``key`` narrowed to the cell in which a group's room ends.

    Adds ``n``, the rows in that range. Ends when no group has more than ``limit`` rows in a range that can be cut.
    """
    while True:
        open_ = stored(open_, "ranges")
        wide = open_.filter((F.col("low") < F.col("high")) & (F.col("n") > limit))
        if wide.isEmpty():
            return open_
        width = F.call_function("div", F.col("high") - F.col("low"), F.lit(CELLS)) + 1
        met = keyed.join(wide, F.col("group").eqNullSafe(F.col("of_group")) & F.col(key).between(F.col("low"), F.col("high")))
        cell = F.call_function("div", F.col(key) - F.col("low"), width).alias("cell")
        counts = met.groupBy("of_group", "room", "low", "high", cell).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(W.partitionBy("of_group").orderBy("cell"))
        reached = counts.withColumn("upto", upto).filter(F.col("upto") >= F.col("room"))
        first = reached.groupBy("of_group").agg(F.min_by(F.struct("room", "low", "high", "cell", "n", "upto"), "cell").alias("at"))
        high = F.least(F.col("high"), F.col("low") + F.col("width") - 1)
        narrow = first.select("of_group", "at.*").withColumn("width", width)
        narrow = narrow.withColumn("low", F.col("low") + F.col("cell") * F.col("width")).withColumn("high", high)
        narrow = narrow.select("of_group", (F.col("room") - F.col("upto") + F.col("n")).alias("room"), "low", "high", "n")
        done = open_.filter((F.col("low") >= F.col("high")) | (F.col("n") <= limit))
        open_ = done.select("of_group", "room", "low", "high", "n").unionByName(narrow)


def needed_rows(rows: DataFrame, group: str, order: list[tuple[str, bool]], limit: int) -> DataFrame:
    """The rows of ``rows`` that can be among the first ``limit`` of their ``group``, and few others.

    ``order`` lists columns and whether they ascend; together they order a group's rows without ties. At most two
    are looked at: a first value that very many rows share is told apart by the second.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    places = [_place(name, kinds[name], ascending) for name, ascending in order[:2]]
    keyed = rows.select(F.col(group).alias("group"), *[p.alias(f"key_{i}") for i, (p, _) in enumerate(places)])
    sizes = keyed.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("key_0").alias("low"), F.max("key_0").alias("high"))
    open_ = sizes.filter(F.col("n") > limit).select(F.col("group").alias("of_group"), F.lit(limit).cast("bigint").alias("room"), "low", "high", "n")
    ends = _narrowed(keyed, "key_0", open_, limit)
    last = ends.select("of_group", F.col("high").alias("end_0"), F.lit(None).cast("bigint").alias("end_1"))
    if len(places) > 1 and places[0][1]:
        tied = ends.filter((F.col("n") > limit) & (F.col("low") == F.col("high"))).select("of_group", "room", F.col("high").alias("tie"))
        tied = stored(tied, "ties")
        own = keyed.join(tied, F.col("group").eqNullSafe(F.col("of_group")) & (F.col("key_0") == F.col("tie")))
        spans = own.groupBy("of_group", "room").agg(F.count(F.lit(1)).alias("n"), F.min("key_1").alias("low"), F.max("key_1").alias("high"))
        of_tie = own.select("group", "key_1")
        second = _narrowed(of_tie, "key_1", spans.select("of_group", "room", "low", "high", "n"), limit)
        second = second.select(F.col("of_group").alias("also"), F.col("high").alias("until"))
        met = last.join(second, F.col("of_group").eqNullSafe(F.col("also")), "left")
        last = met.select("of_group", "end_0", F.col("until").alias("end_1"))
    last = stored(last, "last-values")
    first, *more = (p for p, _ in places)
    behind = F.coalesce(first > F.col("end_0"), F.lit(False))
    if more:
        behind = behind | F.coalesce((first == F.col("end_0")) & (more[0] > F.col("end_1")), F.lit(False))
    met = rows.join(last, F.col(group).eqNullSafe(F.col("of_group")), "left")
    return met.filter(~behind).select(rows.columns)
