import pytest
from pyspark.sql import functions as F

from clickloom.sources import content_key, kept, store


@pytest.fixture()
def folder(monkeypatch, tmp_path):
    monkeypatch.setattr(store, "store_folder", lambda spark: str(tmp_path / "kept"))
    return tmp_path


def source(spark, path, n=5):
    spark.range(n).write.mode("overwrite").parquet(str(path))
    return spark.read.parquet(str(path))


def test_a_second_reader_finds_the_stage(spark, folder):
    df = source(spark, folder / "a").withColumn("x", F.col("id") * 2)
    writes = []

    def build():
        writes.append(1)
        return df.withColumn("y", F.col("x") + 1)

    first = kept(df, "s", ("t", 1), build)
    again = kept(spark.read.parquet(str(folder / "a")).withColumn("x", F.col("id") * 2), "s", ("t", 1), build)
    assert len(writes) == 1 and first.inputFiles() == again.inputFiles() and sorted(r["y"] for r in again.collect()) == [1, 3, 5, 7, 9]
    kept(df, "s", ("t", 2), build)
    assert len(writes) == 2


def test_the_key_follows_plan_files_order_and_settings(spark, folder, monkeypatch):
    a, b = source(spark, folder / "a"), source(spark, folder / "b")
    keys = [content_key(df, 0) for df in (a, b, a.where("id > 1"), a.where("id > 2"), a.unionAll(b), b.unionAll(a), a.limit(0))]
    assert len(set(keys)) == len(keys) and content_key(a, 1) != content_key(a, 0) == content_key(spark.read.parquet(str(folder / "a")), 0)
    before = content_key(a, 0)
    assert content_key(source(spark, folder / "a", 6), 0) != before
    monkeypatch.setattr(store, "code_digest", lambda: "other")
    assert content_key(b, 0) != keys[1]


def test_wide_plans_are_told_apart_by_their_last_column(spark, folder):
    a = source(spark, folder / "a")
    wide = [a.select("id", *[F.lit(i).alias(f"c{i}") for i in range(60)], F.lit(end).alias("z")) for end in (1, 2)]
    assert content_key(wide[0], 0) != content_key(wide[1], 0)


def test_an_unfinished_copy_is_not_read(spark, folder):
    df = source(spark, folder / "a")
    name = folder / "kept" / f"s-{content_key(df, 0)}" / "0"
    name.mkdir(parents=True)
    assert kept(df, "s", 0, lambda: df).count() == 5
