"""Stored indexes: what a lookup reads, and what a load writes."""

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from millrace.operators import postings, search
from millrace.session import fresh_path


def words(spark, first, last):
    rows = spark.range(first, last).select("id", F.array(*[F.concat(F.lit(f"w{k}x"), (F.col("id") % (97 + k)).cast("string")) for k in range(20)]).alias("words"))
    return search.element_index(rows, "words", "id")


def files(root):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{root.removeprefix('file:')}/**/*.parquet", recursive=True)}


def test_lookup_reads_few_row_groups(spark, plan_of):
    root = fresh_path(spark, "postings")
    postings.add_load(words(spark, 0, 60_000), root, 0)
    index = postings.postings(spark, root)
    found = postings.ids_with_all(index, ["w3x5", "w7x9"])
    want = [i for i in range(60_000) if i % 100 == 5 and i % 104 == 9]
    assert sorted(r.id for r in found.collect()) == want
    assert "PushedFilters" in plan_of(found) and "In(term, [w3x5,w7x9])" in plan_of(found).replace("In(term, [w7x9,w3x5])", "In(term, [w3x5,w7x9])")
    hit = total = 0
    for file in files(root):
        if "/postings/" in file:
            data = pq.ParquetFile(file).metadata
            for g in range(data.num_row_groups):
                stats = data.row_group(g).column(data.schema.names.index("term")).statistics
                total += 1
                hit += any(stats.min <= t <= stats.max for t in ("w3x5", "w7x9"))
    assert total >= 6 and hit <= total // 2


def test_a_load_changes_only_its_own_part(spark):
    root = fresh_path(spark, "postings")
    postings.add_load(words(spark, 0, 300), root, 0)
    before = files(root)
    for _ in range(2):  # the second time it replaces itself
        postings.add_load(words(spark, 200, 500), root, 1)
    after = files(root)
    assert all(after[f] == t for f, t in before.items()) and all("load=1" in f for f in after.keys() - before.keys())
    rows = postings.postings(spark, root)
    assert rows.count() == rows.distinct().count() == words(spark, 0, 500).count()
    assert {r.term: r.cnt for r in postings.counts(spark, root).collect()} == {r.term: r["count"] for r in rows.groupBy("term").count().collect()}
    merged = fresh_path(spark, "merged")
    postings.merge_loads(spark, root, merged)
    assert postings.postings(spark, merged).exceptAll(rows).isEmpty() and len(glob.glob(f"{merged.removeprefix('file:')}/postings/load=*")) == 1


def test_more_terms_than_a_list_holds(spark, monkeypatch):
    root = fresh_path(spark, "postings")
    postings.add_load(words(spark, 0, 300), root, 0)
    asked = spark.createDataFrame([(1, "w3x5"), (2, "w0x1"), (3, "none")], "q int, wanted string")
    index = postings.postings(spark, root)
    listed = sorted((r.q, r.id) for r in postings.looked_up(index, asked, "wanted").collect())
    monkeypatch.setattr(postings, "LISTED", 1)
    assert listed and listed == sorted((r.q, r.id) for r in postings.looked_up(index, asked, "wanted").collect())


def test_new_ids_are_settled_before_they_become_trigrams(spark, monkeypatch):
    settled, whole = [], postings.new_ids
    monkeypatch.setattr(postings, "new_ids", lambda rows, root, load: settled.append(rows.columns) or whole(rows, root, load))
    names = spark.range(300).select("id", F.concat(F.lit("name "), F.col("id")).alias("name"))
    root = fresh_path(spark, "names")
    search.add_names(names.where("id < 200"), "id", "name", root, 0)
    short = spark.createDataFrame([(900, "ab"), (901, None)], "id long, name string")
    for _ in range(2):  # the second time it replaces itself
        search.add_names(names.where("id >= 100").union(names.where("id >= 250")).union(short), "id", "name", root, 1)
    assert settled == [["id", "name"]] * 3
    index, frequency = search.stored_index(spark, root)
    want = search.trigram_index(names, "id", "name", keep_name=True)
    assert index.count() == want.count() and index.select(want.columns).exceptAll(want).isEmpty()
    assert frequency.exceptAll(search.trigram_frequency(want)).isEmpty()
    assert sorted((r.load, r.id) for r in spark.read.parquet(f"{root}/ids").collect()) == [(int(i >= 200), i) for i in range(300)]
