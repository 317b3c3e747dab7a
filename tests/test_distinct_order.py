import pytest
from pyspark.sql import functions as F

from clickloom.operators import distinct
from clickloom.operators.distinct import distinct_rows
from clickloom.sources import cut_by_position, read_space_text, stage, with_file_rows
from clickloom.sources.files import write_space_text


@pytest.fixture()
def rows(spark):
    data = [(1, None, "x", ["a"]), (None, 1, "x", ["a"]), (1, None, "x", ["a"]), (2, 2, None, None), (2, 2, None, None), (3, 3, "", []), (3, 3, None, [])]
    return stage(spark.createDataFrame(data * 2 + [(i, i, "only", [str(i)]) for i in range(50)], "a int, b int, c string, d array<string>").repartition(3))


@pytest.mark.parametrize("bound", [0, 1 << 20])
def test_distinct_rows(rows, bound):
    got = distinct_rows(rows, bound)
    assert got.columns == rows.columns and sorted(map(str, got.collect())) == sorted(map(str, rows.dropDuplicates().collect()))
    assert got.count() == 55


def test_rows_of_colliding_digests_are_told_apart(rows, monkeypatch):
    monkeypatch.setattr(distinct, "digests", lambda columns: (F.lit(1), F.lit(2)))
    assert sorted(map(str, distinct_rows(rows).collect())) == sorted(map(str, rows.dropDuplicates().collect()))


def test_wide_rows_are_not_shuffled(rows):
    """Few repeats: their row numbers are broadcast, so the plan of the result exchanges no row."""
    plan = distinct_rows(rows)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    plain = rows.where("c = 'only'")
    assert distinct_rows(stage(plain)).count() == 50


def test_file_order_over_many_splits(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("n"), F.expr("repeat('x', cast(id % 40 AS int))").alias("t"))
    write_space_text(df.repartitionByRange(3, "n").sortWithinPartitions("n"), str(tmp_path / "t"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("2000", "9000", "134217728"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            read = read_space_text(spark, str(tmp_path / "t"), df.schema)
            numbered = with_file_rows(read)
            assert numbered.where("n <> file_row").count() == 0 and numbered.count() == 3000
            first, rest = cut_by_position(numbered, 1234)
            assert first.count() == 1234 and rest.agg(F.min("n")).first()[0] == 1234 and first.columns == ["n", "t"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_file_order_of_nothing(spark, tmp_path):
    write_space_text(spark.range(5).where("id > 9"), str(tmp_path / "t"))
    assert with_file_rows(read_space_text(spark, str(tmp_path / "t"), spark.range(1).schema)).count() == 0
