"""Versioned tables: switches by one file, folders that never change, writers that are lost."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from millrace.session import fresh_path
from millrace.sources import versions


@pytest.fixture
def months(spark):
    table = versions.VersionedTable(spark, fresh_path(spark, "versions"), F.col("month"))
    table.reload(rows(spark, 0, 90))
    return table


def rows(spark, first, last):
    return spark.range(first, last).select("id", F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string")).alias("month"), (F.col("id") * 2).alias("v"))


def data_files(table):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{table.root.removeprefix('file:')}/data/**/*.parquet", recursive=True)}


def ids(df):
    return sorted(r.id for r in df.collect())


def test_changes_leave_older_versions_whole(months, spark):
    before = data_files(months)
    side = months.detach("2024-02")
    assert ids(months.read()) == [i for i in range(90) if i % 3 != 1] and ids(months.read(version=0)) == list(range(90))
    with pytest.raises(FileNotFoundError):
        months.detach("2024-02")
    with pytest.raises(ValueError):
        months.attach("2024-09", side)
    months.attach("2024-02", side)
    with pytest.raises(FileExistsError):
        months.attach("2024-02", side)
    months.drop_parts(lambda m: m < "2024-02")
    months.append(rows(spark, 90, 99).withColumn("note", F.lit("x")))
    assert ids(months.read()) == [i for i in range(90) if i % 3] + list(range(90, 99))
    assert months.read().where("note is null").count() == 60
    assert {f: t for f, t in data_files(months).items() if f in before} == before
    assert months.versions() == [0, 1, 2, 3, 4]


def test_a_lost_writer_changes_nothing(months, spark, monkeypatch):
    def lost(schema, parts):
        raise RuntimeError("lost before the manifest")

    with monkeypatch.context() as m:
        m.setattr(months, "commit", lost)
        with pytest.raises(RuntimeError):
            months.reload(rows(spark, 0, 3))
    assert ids(months.read()) == list(range(90))
    path, fs = months._path("versions/1.json")  # a manifest that was cut off
    out = fs.create(path, False)
    out.write(bytearray(b'{"schema": {"ty'))
    out.close()
    assert ids(months.read()) == list(range(90))
    months.reload(rows(spark, 0, 3))
    assert ids(months.read()) == [0, 1, 2] and months.versions() == [0, 1, 2]


def test_two_writers_of_one_version(months, spark, monkeypatch):
    monkeypatch.setattr(months, "versions", lambda: [])
    with pytest.raises(versions.Conflict):
        months.commit(months.read(version=None).schema if False else rows(spark, 0, 1).schema, {})


def test_an_open_reader_sees_its_version(months, spark):
    reader = months.read()
    months.reload(rows(spark, 0, 3))
    assert ids(reader) == list(range(90))
    assert len(months.vacuum(keep=1)) == 3 and ids(months.read()) == [0, 1, 2]


def test_updates_and_merges_write_touched_parts_only(spark):
    table = versions.VersionedTable(spark, fresh_path(spark, "parts"), versions.hash_part("id", 8))
    table.reload(spark.range(100).select("id", (F.col("id") % 5).alias("q")))
    before = dict(table.manifest()["parts"])
    table.update_where_key_in(spark.createDataFrame([(3,), (3,), (1000,)], "id long"), "id", "q", F.col("q") + 1000)
    after = table.manifest()["parts"]
    assert sum(before[p] != after.get(p) for p in before) <= 2 and before.keys() == after.keys()
    assert {r.id: r.q for r in table.read().collect()} == {i: i % 5 + 1000 * (i == 3) for i in range(100)}
    table.merge_additive(spark.createDataFrame([(3, 1), (500, 7), (500, 1)], "id long, q long"), ["id"], ["q"])
    assert {r.id: r.q for r in table.read().collect()} == {i: i % 5 + 1001 * (i == 3) for i in range(100)} | {500: 8}
    untouched = [p for p in after if p not in table.touched(spark.createDataFrame([(3,), (500,)], "id long"))]
    assert all(table.manifest()["parts"][p] == after[p] for p in untouched) and len(untouched) >= 6


def test_empty_tables(spark):
    table = versions.VersionedTable(spark, fresh_path(spark, "empty"))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.reload(spark.createDataFrame([], "id long"))
    assert table.read().columns == ["id"] and table.read().count() == 0 and table.parts() == []
    table.append(spark.createDataFrame([(None,)], "id long"))
    assert table.read().count() == 1
