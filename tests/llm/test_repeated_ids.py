"""Near duplicates of repeated ids and rows, and clashing columns."""

import random

from corpus import frame, key, near_duplicates, texts
from pyspark.sql import functions as F

from skyledger.llm import neardup


def _texts():
    pick = random.Random(12)
    a, b = (" ".join("".join(pick.choices("abcdefgh", k=5)) for _ in range(60)) for _ in range(2))
    return a, b


def test_ids_unite_their_texts(spark):
    a, b = _texts()
    rows = [(7, a, "x"), (7, b, "x"), (3, b, "x"), (9, a, "x"), (12, b + " more", "x"), (20, "", "x"), (20, a, "x"), (30, None, "x"), (30, "other words", "x"), (None, a, "x")]
    found = neardup.near_duplicates(frame(spark, rows))
    assert sorted(map(tuple, found.select("doc_id", "n_shingles", "component_id").collect()), key=key) == sorted((r[:3] for r in near_duplicates(rows)), key=key)
    assert {r.component_id for r in found.where("doc_id IN (3, 7, 9, 12, 20)").collect()} == {3}


def test_many_copies_of_one_row(spark):
    a, b = _texts()
    near = a.rsplit(" ", 1)[0] + " end"
    rows = spark.range(30_000).select(F.lit(5).cast("bigint").alias("doc_id"), F.lit(a).alias("text")).union(spark.createDataFrame([(8, near), (9, b)], "doc_id bigint, text string"))
    found = neardup.near_duplicates(rows).groupBy("doc_id", "component_id").count().collect()
    assert sorted(map(tuple, found)) == [(5, 5, 30_000), (8, 5, 1), (9, 9, 1)]
    assert sorted(r.doc_id for r in neardup.deduplicated(rows).collect()) == [5, 9]


def test_columns_with_inner_names(spark):
    rows = frame(spark, [r for r in texts() if r[0] != 509])
    for name in ("_id", "_row", "row", "print", "gone", "n", "_print", "first", "known"):
        rows = rows.withColumn(name, F.lit("mine"))
    kept = neardup.deduplicated(rows)
    assert kept.columns == rows.columns and [f.dataType for f in kept.schema] == [f.dataType for f in rows.schema]
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == {i for i, _, _, k in near_duplicates([r for r in texts() if r[0] != 509]) if k and i is not None}
    assert {r._id for r in kept.collect()} == {"mine"}
