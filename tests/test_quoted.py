"""CSV files with line breaks in quoted cells, split into many blocks."""

import random

import pytest
from pyspark.sql import functions as F

from skyledger.sources import delimited, quoted


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], "150")
    spark.conf.set(names[1], "1")
    yield
    for n in names:
        if before[n] is None:
            spark.conf.unset(n)
        else:
            spark.conf.set(n, before[n])


def content(seed: int, end: str = "\n") -> str:
    pick = random.Random(seed)

    def cell() -> str:
        text = "".join(pick.choices(["a", "bc", " ", "é", "12"], k=pick.randint(0, 5)))
        kind = pick.random()
        if kind < 0.3:
            return '"' + text + pick.choice(["", end, end * 3, '""', ",", f'x{end}""{end}y, z']) + text + '"'
        if kind < 0.4:
            return f'a"{text}'  # a stray quote inside an unquoted cell
        return text

    rows = [",".join(cell() for _ in range(pick.choice([3, 3, 3, 2, 4]))) for _ in range(80)]
    rows.insert(40, '"' + ("long text" + end) * 100 + '",b,c')  # a cell over several blocks
    rows.insert(20, "")
    return end.join(["x,y,z", *rows]) + (end if seed % 2 else "")


def whole_file(spark, path: str):
    reader = spark.read.option("multiLine", True).option("header", True).option("escape", '"')
    return reader.schema("x string, y string, z string").csv(path)


@pytest.mark.parametrize("seed", range(6))
def test_blocks_equal_whole_files(spark, small_blocks, tmp_path, seed):
    path = tmp_path / "a.csv"
    path.write_text(content(seed, "\r\n" if seed == 3 else "\n"), newline="")
    scan = delimited.scan_delimited(spark, str(path))
    assert scan.select("_row_ord.block").distinct().count() > 5
    got = scan.orderBy("_row_ord").select("x", "y", "z").collect()
    expected = whole_file(spark, str(path)).collect()
    # The scan makes null tokens null.
    filled = [[tuple((v or "").strip() for v in r) for r in rows] for rows in (got, expected)]
    assert filled[0] == filled[1]


def test_one_task_per_block(spark, small_blocks, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("x,y\n" + "".join(f'{i},"a{i}\nb"\n' for i in range(500)))
    records = quoted.read_records(spark, [str(path)])
    tasks = records.select(F.spark_partition_id().alias("p"), F.expr("count(*) OVER ()")).distinct().count()
    assert records.count() == 501 and tasks > 10
    most = records.groupBy("block").count().agg(F.max("count")).first()[0]
    assert most < 30


def test_open_cells():
    # Line: open behind it if none was before, and if one was.
    cases = {"": (False, True), "a,b": (False, True), 'a,"b': (True, False), 'a,b"c': (False, False), '"a""': (True, False), '""': (False, True)}
    cases |= {'b",c': (False, False), 'x,"y": "z': (False, False), '","': (False, True), 'a"b,"c': (True, True)}
    for line, expected in cases.items():
        assert (quoted.is_open(line, False), quoted.is_open(line, True)) == expected, line


def test_unclosed_cell_ends_with_the_file(spark, small_blocks, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('x,y\n1,2\n3,"open\n' + "more\n" * 100)
    rows = delimited.scan_delimited(spark, str(path)).orderBy("_row_ord").select("x", "y").collect()
    assert [r.x for r in rows] == ["1", "3"] and rows[1].y.startswith("open\nmore") and rows[1].y.count("more") == 100
