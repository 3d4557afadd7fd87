"""Keyed writes as set transformations: upsert, partial update, delete, column update.

Each call returns the table as it is after the write; ``publish`` stores it as a
new version. Tables are unique on ``key``. Where a batch may hold a key more than
once, name the column that orders its rows and the last one counts; without such a
column a repeated key is an error, never a second row. The batch side of the anti
joins carries keys only, so Spark broadcasts it while it is small and the table
itself is then not shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.fixed import BATCH_USER
from spendlake.session import stored


def required_key(batch: DataFrame, key: str) -> DataFrame:
    """The batch, with an error for any row that lacks its key."""
    missing = F.raise_error(F.lit(f"row without a {key}")).cast(batch.schema[key].dataType)
    return batch.withColumn(key, F.coalesce(F.col(key), missing))


def last_per_key(batch: DataFrame, key: str, order_by: str) -> DataFrame:
    """One row per key: the one that sorts last, NULL first; of equal ones the one whose columns do.

    The aggregate combines before the shuffle.
    """
    rest = [name for name in batch.columns if name != key]
    last = batch.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order_by, F.struct(*rest))).alias("last"))
    return last.select(key, "last.*").select(batch.columns)


def one_per_key(batch: DataFrame, key: str, order_by: str | None = None) -> DataFrame:
    """The last row of each key, or without an order its only one; a key that repeats is then an error."""
    if order_by:
        return last_per_key(batch, key, order_by)
    rest = [name for name in batch.columns if name != key]
    only = batch.groupBy(key).agg(F.any_value(F.struct(*rest)).alias("only"), F.count(F.lit(1)).alias("times"))
    repeated = F.raise_error(F.concat(F.lit(f"{key} repeats without an order: "), F.col(key).cast("string")))
    checked = F.when(F.col("times") == 1, F.col("only")).otherwise(repeated.cast(only.schema["only"].dataType))
    return only.select(key, checked.alias("only")).select(key, "only.*").select(batch.columns)


def upsert(table: DataFrame, batch: DataFrame, key: str, order_by: str | None = None) -> DataFrame:
    """Whole rows replace those with the same key; new keys are added. The batch is read twice."""
    batch = required_key(batch, key)
    rows = one_per_key(batch, key, order_by).select(table.columns)
    return without_keys(table, rows, key).unionByName(rows)


def append(table: DataFrame, rows: DataFrame, id_column: str | None = None) -> DataFrame:
    if id_column:
        rows = rows.withColumn(id_column, F.uuid())
    return table.unionByName(rows)


def append_files(rows: DataFrame, path: str, partition_by: Sequence[str] = (), id_column: str | None = None) -> None:
    if id_column:
        rows = rows.withColumn(id_column, F.uuid())
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def delete(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed; unknown ids do nothing.

    Repeated ids are dropped before the shuffle, so one id that fills the list does no harm.
    """
    return without_keys(table, ids.select(key).distinct(), key)


def without_keys(table: DataFrame, unique: DataFrame, key: str) -> DataFrame:
    """``delete`` for keys that are known to be listed once."""
    return table.join(unique.select(key), key, "left_anti").select(table.columns)


def partial_upsert(table: DataFrame, batch: DataFrame, key: str, order_by: str | None = None) -> DataFrame:
    """Only supplied columns change, a supplied NULL included; absent keys are added."""
    supplied = [name for name in batch.columns if name not in (key, order_by)]
    new = one_per_key(required_key(batch, key), key, order_by).select(key, F.struct(*supplied).alias("new"))
    merged = table.join(new, key, "full_outer")
    return merged.select(*[_merged(table, name, supplied, key) for name in table.columns])


def _merged(table: DataFrame, name: str, supplied: Sequence[str], key: str) -> Column:
    if name == key or name not in supplied:
        return F.col(name)
    new = F.col(f"new.{name}").cast(table.schema[name].dataType)
    return F.when(F.col("new").isNotNull(), new).otherwise(F.col(name)).alias(name)


def update_columns(
    table: DataFrame,
    updates: DataFrame,
    key: str,
    stamps: Mapping[str, Column] | None = None,
    order_by: str | None = None,
) -> DataFrame:
    """New values for the columns of ``updates`` where its key matches; other rows stay as they are."""
    values = [name for name in updates.columns if name not in (key, order_by)]
    new = one_per_key(updates, key, order_by).select(key, F.struct(*values).alias("new"))
    joined = table.join(new, key, "left")
    matched = F.col("new").isNotNull()
    columns = []
    for name in table.columns:
        kind = table.schema[name].dataType
        if stamps and name in stamps:
            columns.append(F.when(matched, stamps[name]).otherwise(F.col(name)).cast(kind).alias(name))
        elif name in values:
            columns.append(F.when(matched, F.col(f"new.{name}").cast(kind)).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return joined.select(*columns)


def batch_stamps(now: Column) -> dict[str, Column]:
    return {"updated_at": now, "updated_by": F.lit(BATCH_USER)}


def upsert_index_rows(index: DataFrame, rows: DataFrame, key: str, now: Column) -> DataFrame:
    """Denormalised rows replace or join the index, stamped even when they are new.

    The rows are stored first, since they come from many joins and are read twice.
    """
    return upsert(index, stored(index_rows(rows, now).select(index.columns), "index-rows"), key)


def index_rows(rows: DataFrame, now: Column) -> DataFrame:
    stamped = rows.withColumns(batch_stamps(now))
    return stamped.withColumn("agg_group_seq", F.coalesce("agg_group_seq", F.lit(0).cast("bigint")))


def upsert_keeping_creation(table: DataFrame, rows: DataFrame, key: str, now: Column) -> DataFrame:
    """Existing rows take the new attributes and an update stamp but keep ``created_*``; new rows go in as given."""
    audit = {"created_at", "created_by", "updated_at", "updated_by"}
    attributes = [name for name in table.columns if name != key and name not in audit]
    old = table.select(key, F.struct(*[c for c in table.columns if c != key]).alias("old"))
    new = rows.select(key, F.struct(*[c for c in table.columns if c != key]).alias("new"))
    merged = old.join(new, key, "full_outer")
    kept, added = F.col("new").isNull(), F.col("old").isNull()
    columns = [F.col(key)]
    for name in table.columns:
        if name == key:
            continue
        if name in attributes:
            value = F.when(kept, F.col(f"old.{name}")).otherwise(F.col(f"new.{name}"))
        elif name.startswith("created_"):
            value = F.when(added, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        else:
            stamp = batch_stamps(now)[name]
            value = (
                F.when(added, F.col(f"new.{name}")).when(kept, F.col(f"old.{name}")).otherwise(stamp)
            )
        columns.append(value.cast(table.schema[name].dataType).alias(name))
    return merged.select(*columns).select(table.columns)
