"""Tables replaced in one step."""

import pytest
from pyspark.sql import functions as F

from skyledger.operators import snapshots


def test_readers_see_old_or_new_rows_only(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not snapshots.exists(spark, path)
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, path)
    assert snapshots.publish(spark.range(10), path) == 10
    begun = snapshots.read(spark, path)
    failing = spark.range(100, 2000, 1, 8).select(F.when(F.col("id") == 1999, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        snapshots.publish(failing, path)
    assert snapshots.read(spark, path).count() == 10
    assert snapshots.publish(spark.range(3), path) == 3
    # A reader that has begun goes on with the rows it found.
    assert begun.count() == 10 and snapshots.read(spark, path).count() == 3
    assert snapshots.read(spark, path, number=0).count() == 10
    assert snapshots.vacuum(spark, path, keep=1) == 2
    assert snapshots.versions(spark, path) == [1] and snapshots.read(spark, path).count() == 3


def test_a_table_replaced_by_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.publish(spark.range(5), path)
    snapshots.publish(snapshots.read(spark, path).where("id > 1"), path)
    assert sorted(r.id for r in snapshots.read(spark, path).collect()) == [2, 3, 4]


def test_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    for part, n in (("v1", 4), ("v2", 2), ("v1", 0)):
        assert snapshots.publish(spark.range(n).withColumn("p", F.lit(part)), path, part) == n
    assert snapshots.read(spark, path, "v1").count() == 0
    assert [r.p for r in snapshots.read(spark, path).collect()] == ["v2", "v2"]
    never = snapshots.read(spark, path, "v9")
    assert never.count() == 0 and never.columns == ["id", "p"]
    snapshots.publish(spark.range(1).withColumn("more", F.lit(1)), path, "v3")
    assert sorted(snapshots.read(spark, path).columns) == ["id", "more", "p"]


def test_two_writers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    snapshots.publish(spark.range(1), path, "a")
    rename, calls = snapshots._Folder.rename, []

    def slow(self, old, new):
        if not calls:
            calls.append(new)
            snapshots.publish(spark.range(2), path, "b")  # another writer takes the number first
        return rename(self, old, new)

    monkeypatch.setattr(snapshots._Folder, "rename", slow)
    snapshots.publish(spark.range(3), path, "c")
    assert snapshots.versions(spark, path) == [0, 1, 2]
    assert [snapshots.read(spark, path, p).count() for p in "abc"] == [1, 2, 3]
