from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spendlake.operators.publish import VersionedTable
from spendlake.schemas import schema_from_mapping

FIRST, SECOND, THIRD = (datetime(2024, 1, day) for day in (1, 2, 3))


@pytest.fixture
def target(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path), "spent_type")


def test_publishing_replaces_and_drops_the_old_version(spark, target, tmp_path):
    target.publish(spark.range(3), FIRST)
    target.publish(spark.range(5), SECOND)
    assert target.versions() == ["spent_type_20240102000000"]
    assert target.read().count() == 5
    assert not (tmp_path / "spent_type_20240101000000").exists()


def test_older_versions_can_be_kept(spark, target):
    for moment in (FIRST, SECOND, THIRD):
        target.publish(spark.range(1), moment, keep=1)
    assert target.versions() == ["spent_type_20240102000000", "spent_type_20240103000000"]


def test_a_failed_publish_leaves_the_current_version(spark, target, tmp_path):
    target.publish(spark.range(3), FIRST)
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        target.publish(broken, SECOND)
    assert target.versions() == ["spent_type_20240101000000"]
    assert not (tmp_path / "spent_type_20240102000000").exists()


def test_the_same_version_cannot_be_published_twice(spark, target):
    target.publish(spark.range(3), FIRST)
    with pytest.raises(ValueError, match="already published"):
        target.publish(spark.range(4), FIRST)
    assert target.read().count() == 3


def test_reading_before_publishing(target):
    with pytest.raises(LookupError):
        target.read()


def test_mapping_gives_the_written_columns(spark, target):
    mapping = '{"mappings": {"properties": {"id": {"type": "integer"}, "at": {"type": "date"}}}, "settings": {}}'
    frame = spark.range(2).withColumns({"at": F.lit("2024-01-01").cast("date"), "other": F.lit(1)})
    target.publish(frame, FIRST, schema_from_mapping(mapping))
    assert rows(target.read(), "id", "at") == [(0, FIRST), (1, FIRST)]
    assert target.read().columns == ["id", "at", "other"]


def test_tables_whose_names_begin_alike_are_kept_apart(spark, tmp_path):
    longer = VersionedTable(spark, str(tmp_path), "spent_type_indexing")
    longer.publish(spark.range(9), THIRD)
    shorter = VersionedTable(spark, str(tmp_path), "spent_type")
    shorter.publish(spark.range(2), FIRST)
    shorter.publish(spark.range(3), SECOND)
    assert shorter.read().count() == 3 and longer.read().count() == 9


def test_files_hold_ranges_of_the_sort_column(spark, target):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        target.publish(spark.range(10_000).repartition(4), FIRST, sort_by=["id"])
    finally:
        spark.conf.unset(setting)
    files = target.read().groupBy(F.input_file_name()).agg(F.min("id").alias("low"), F.max("id").alias("high"))
    ranges = sorted((row.low, row.high) for row in files.collect())
    assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_mapping_without_mappings_is_an_error():
    with pytest.raises(ValueError, match="mappings"):
        schema_from_mapping({"settings": {}})
    with pytest.raises(ValueError, match="unsupported"):
        schema_from_mapping({"mappings": {"properties": {"x": {"type": "geo_point"}}}})


def test_nested_mapping_fields():
    schema = schema_from_mapping({"mappings": {"properties": {"a": {"properties": {"b": {"type": "keyword"}}}}}})
    assert schema.simpleString() == "struct<a:struct<b:string>>"


def test_a_killed_publish_leaves_nothing_after_the_next(spark, target, tmp_path, monkeypatch):
    target.publish(spark.range(3), FIRST)
    with monkeypatch.context() as killed:  # neither the marker nor the clean-up is reached
        killed.setattr(target, "_create", lambda marker: (_ for _ in ()).throw(KeyboardInterrupt()) if "published" in marker else VersionedTable._create(target, marker))
        killed.setattr(target._fs, "delete", lambda *_: None, raising=False)
        with pytest.raises(KeyboardInterrupt):
            target.publish(spark.range(5), SECOND)
    assert (tmp_path / "spent_type_20240102000000").exists() and (tmp_path / "_started/spent_type_20240102000000").exists()
    target.publish(spark.range(4), datetime(2024, 1, 2, 12))  # perhaps it still goes on
    assert (tmp_path / "spent_type_20240102000000").exists()
    target.publish(spark.range(4), THIRD)
    assert not (tmp_path / "spent_type_20240102000000").exists() and not list((tmp_path / "_started").glob("sp*"))
    assert target.versions() == ["spent_type_20240103000000"] and target.read().count() == 4
