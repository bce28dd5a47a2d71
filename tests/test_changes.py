"""Files that are delivered again under their name."""

import os
import shutil

from pyspark.sql import functions as F

from skyledger.operators import snapshots
from skyledger.streaming import changes


def kinds(found):
    return {r.path.rsplit("/", 1)[1]: r.change for r in found.collect()}


def test_kinds_of_changes(spark, tmp_path):
    folder, manifest = tmp_path / "in", str(tmp_path / "manifest")
    folder.mkdir()
    for name in "abcd":
        (folder / f"{name}.csv").write_text(f"x\n{name}\n")

    def step():
        found = changes.changes(spark, changes.listing(spark, str(folder), "*.csv"), changes.known_files(spark, manifest))
        snapshots.publish(found.where("change <> 'removed'").select("path", "length", "modified", "checksum"), manifest)
        return found

    assert kinds(step()) == dict.fromkeys(["a.csv", "b.csv", "c.csv", "d.csv"], "added")
    (folder / "a.csv").write_text("x\nother\n")
    (folder / "b.csv").write_text("x\nB\n")  # of the same length
    os.utime(folder / "b.csv", (1, 1))
    os.utime(folder / "c.csv", (1, 1))
    (folder / "d.csv").unlink()
    (folder / "e.csv").write_text("x\n")
    (folder / "empty.csv").write_text("")
    (folder / "note.txt").write_text("not matched")
    found = step()
    assert kinds(found) == {"a.csv": "changed", "b.csv": "changed", "c.csv": "same", "d.csv": "removed", "e.csv": "added"}
    assert kinds(step()) == {"a.csv": "same", "b.csv": "same", "c.csv": "same", "e.csv": "same"}
    shutil.rmtree(folder)
    folder.mkdir()
    gone = changes.changes(spark, spark.createDataFrame([], "path string, length bigint, modified timestamp"), changes.known_files(spark, manifest))
    assert gone.where("change <> 'removed'").count() == 0 and gone.where(F.col("checksum").isNull()).count() == 0
