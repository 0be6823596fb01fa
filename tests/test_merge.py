from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from eventmart.operators.merge import assert_unique, delete_where, erase_subjects, merge_upsert
from eventmart.sources import catalog
from tests.conftest import rows


def make(spark, *data):
    return spark.createDataFrame(list(data), "k string, v int")


def test_upsert(spark):
    got = merge_upsert(make(spark, ("a", 1), ("b", 2)), make(spark, ("b", 3), ("c", 4)), ["k"])
    assert rows(got) == [("a", 1), ("b", 3), ("c", 4)]


def test_duplicate_source_keys_fail(spark):
    with pytest.raises(Exception, match="more than one source row"):
        merge_upsert(make(spark), make(spark, ("b", 3), ("b", 4)), ["k"]).collect()
    assert merge_upsert(make(spark), make(spark, ("b", 3), ("b", 4)), ["k"], on_duplicate="keep").count() == 2


def test_null_keys(spark):
    target, source = make(spark, (None, 1)), make(spark, (None, 2))
    assert rows(merge_upsert(target, source, ["k"])) == [(None, 1), (None, 2)]
    assert rows(merge_upsert(target, source, ["k"], null_safe=True)) == [(None, 2)]
    two = make(spark, (None, 2), (None, 3))
    assert assert_unique(two, ["k"], nulls_equal=False).count() == 2
    with pytest.raises(Exception, match="more than one source row"):
        assert_unique(two, ["k"]).collect()


def test_column_order_follows_target(spark):
    source = make(spark, ("a", 5)).select("v", "k")
    assert merge_upsert(make(spark, ("a", 1)), source, ["k"]).collect() == [("a", 5)]


def test_delete_keeps_unknown(spark):
    assert rows(delete_where(make(spark, ("a", None), ("b", 1)), F.col("v") == 1)) == [("a", None)]


def test_erase_in_order(spark):
    tables = {"gold": (make(spark, ("a", 1), ("b", 2)), "k"), "silver": (make(spark, ("a", 3), (None, 4)), "k")}
    out = erase_subjects(tables, make(spark, ("a", 0)).select(F.col("k").alias("user_id")))
    assert list(out) == ["gold", "silver"]
    assert rows(out["gold"]) == [("b", 2)]
    assert rows(out["silver"]) == [(None, 4)]


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex[:8]}"


def test_table_upsert_and_rerun(spark, name):
    for _ in range(2):
        catalog.upsert_table(make(spark, ("a", 1), ("b", 2)), name, ["k"])
        catalog.upsert_table(make(spark, ("b", 3), ("c", 4)), name, ["k"])
    assert rows(spark.table(name)) == [("a", 1), ("b", 3), ("c", 4)]


def test_table_upsert_rewrites_touched_partitions_only(spark, name):
    schema = "day string, k string, v int"
    base = spark.createDataFrame([("d1", "a", 1), ("d2", "b", 2), (None, "n", 5)], schema)
    catalog.upsert_table(base, name, ["day", "k"], null_safe=True, partition_by=["day"])

    def files():
        found = spark.table(name).select("day", F.col("_metadata.file_path")).distinct()
        return {r[0]: r[1] for r in found.collect()}

    before = files()
    catalog.upsert_table(
        spark.createDataFrame([("d2", "b", 9), ("d2", "c", 3)], schema), name, ["day", "k"], null_safe=True, partition_by=["day"]
    )
    after = files()
    assert rows(spark.table(name).select("day", "k", "v")) == rows(
        spark.createDataFrame([("d1", "a", 1), ("d2", "b", 9), ("d2", "c", 3), (None, "n", 5)], schema)
    )
    assert before["d1"] == after["d1"] and before["d2"] != after["d2"]
    catalog.upsert_table(
        spark.createDataFrame([(None, "n", 6)], schema), name, ["day", "k"], null_safe=True, partition_by=["day"]
    )
    assert spark.table(name).filter("day is null").select("v").collect() == [(6,)]


def test_partition_columns_must_be_keys(spark, name):
    with pytest.raises(ValueError):
        catalog.upsert_table(make(spark), name, ["k"], partition_by=["v"])


def test_delete_from_partitions(spark, name):
    schema = "day string, n int, v int"
    data = spark.createDataFrame([("d1", 1, 1), ("d1", 2, 2), ("d'2", 3, 3), (None, 4, 4)], schema)
    catalog.replace_table(data, name, ["day", "n"])
    catalog.delete_rows(spark, name, F.col("v") > 1)
    assert rows(catalog.read_table(spark, name).select("day", "n", "v")) == [("d1", 1, 1)]
    catalog.replace_table(data, name)
    assert rows(catalog.read_table(spark, name).select("day", "n", "v")) == rows(data)


def test_append_and_delete(spark, name):
    catalog.append_table(make(spark, ("a", 1)), name)
    catalog.append_table(make(spark, ("b", 2)).select("v", "k"), name)
    catalog.delete_rows(spark, name, F.col("k") == "a")
    assert rows(catalog.read_table(spark, name)) == [("b", 2)]
    before = catalog.table_location(spark, name)
    catalog.delete_rows(spark, name, F.col("k") == "none such")
    assert catalog.table_location(spark, name) == before  # nothing to delete, nothing rewritten
    assert name in [r.table_name for r in catalog.table_names(spark, prefix=name).collect()]


def test_a_reader_sees_old_or_new_rows_at_every_step(spark, name, monkeypatch):
    """After each statement of a replacement the table has one version's rows, also for a reader that began before it."""
    old, new = make(spark, ("a", 1), ("b", 2)), make(spark, ("a", 3), ("c", 4))
    old.write.saveAsTable(name)
    catalog.replace_table(old, name)  # so that there is a version before
    began, seen = catalog.read_table(spark, name), []

    class Watched:
        """The session, looked at after every statement."""

        def __getattr__(self, attribute):
            return getattr(spark, attribute)

        def sql(self, text):
            out = spark.sql(text)
            if text.startswith("alter table"):
                seen.append(rows(catalog.read_table(spark, name)))
            return out

    monkeypatch.setattr(type(new), "sparkSession", property(lambda _: Watched()))
    catalog.replace_table(new, name)
    monkeypatch.undo()
    assert seen[0] == rows(old) and seen[-1] == rows(new) and len(seen) == 2
    assert rows(began) == rows(old)
    assert rows(catalog.read_table(spark, name)) == rows(new)


def test_old_versions_go(spark, name):
    for v in range(5):
        catalog.replace_table(make(spark, ("a", v)), name)
    folder = catalog._version_folders(spark, name)[0].removeprefix("file:")
    assert len(os.listdir(folder)) == 2  # the present one and the one before
    catalog.append_table(make(spark, ("b", 1)), name)
    catalog.upsert_table(make(spark, ("a", 9)), name, ["k"])
    assert rows(catalog.read_table(spark, name)) == [("a", 9), ("b", 1)]
    catalog.drop_table(spark, name)
    assert not os.path.exists(folder)
    catalog.replace_table(make(spark, ("z", 1)), name)
    assert rows(catalog.read_table(spark, name)) == [("z", 1)]


def test_partition_writes_leave_the_session_alone(spark, name, monkeypatch):
    schema = "day string, v int"
    spark.createDataFrame([("d1", 1), ("d2", 2)], schema).write.partitionBy("day").saveAsTable(name)
    monkeypatch.setattr(type(spark.conf), "set", lambda *_: pytest.fail("a setting is changed"))
    found = catalog.overwrite_partitions(spark.createDataFrame([("d2", 5), (None, 6), ("d'3", 7)], schema), name)
    assert {r.day for r in found} == {"d2", None, "d'3"}
    assert rows(catalog.read_table(spark, name).select("day", "v")) == sorted([("d1", 1), ("d2", 5), (None, 6), ("d'3", 7)], key=repr)


def test_erased_subjects_leave_other_partitions_alone(spark, name):
    schema = "day string, user_id int"
    data = spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 3), (None, 4), (None, 1), ("d4", None)], schema)
    data.repartition("day").write.partitionBy("day").saveAsTable(name)

    def files():
        return {r[1]: r[0] for r in catalog.read_table(spark, name).select("day", "_metadata.file_path").distinct().collect()}

    before = files()
    catalog.delete_matches(spark, name, spark.createDataFrame([(1,), (1,), (None,)], "id int"), "user_id", "id")
    assert rows(catalog.read_table(spark, name).select("day", "user_id")) == sorted([("d1", 2), ("d2", 3), (None, 4), ("d4", None)], key=repr)
    assert {before[f] for f in before.keys() & files().keys()} == {"d2", "d4"}
    kept = files()
    catalog.delete_matches(spark, name, spark.createDataFrame([(99,)], "id int"), "user_id", "id")
    assert files() == kept
    catalog.delete_matches(spark, name, spark.createDataFrame([(3,)], "id int"), "user_id", "id")
    assert catalog.read_table(spark, name).filter("day = 'd2'").count() == 0


@pytest.mark.parametrize("null_safe", [False, True])
def test_row_level_merge_resolves_its_columns(spark, name, monkeypatch, null_safe):
    """No format with row-level changes is installed: Spark must refuse the table, not the condition."""
    make(spark, ("a", 1)).write.saveAsTable(name)
    monkeypatch.setattr(catalog, "_row_level", lambda *_: True)
    for table in (name, f"default.{name}"):
        with pytest.raises(Exception, match="does not support MERGE INTO TABLE"):
            catalog.upsert_table(make(spark, ("a", 2)), table, ["k"], null_safe=null_safe)
