"""The registered queries and the pipeline on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from millrace.llm import decontaminate, linededup, neardup, packing, quality
from millrace.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not present")


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.sql(f"create view {file.removesuffix('.parquet')} as select * from '{SMALL}/{file}'")
    result = con.sql(ORACLES[name])
    df = QUERIES[name](spark, SMALL)
    assert sorted(map(repr, (tuple(r) for r in df.select(*result.columns).collect()))) == sorted(map(repr, result.fetchall()))


@needs_data
@pytest.mark.parametrize("name", ["op2_url_filter", "op5_line_dedup", "op6_chat_format"])
def test_native_plans_have_no_python(spark, plan_of, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@needs_data
def test_pipeline_stages(spark):
    """Each stage keeps and drops what its operator says, on what the stage before it kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL).cache()
        assert after.columns == columns
        before, left = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in after.collect()}
        if name == "quality rules":
            want = {i for i, r in before.items() if quality.measured(r.text, quality.Rules())[0][quality._KEPT]}
        elif name == "line dedup":
            want = {r.doc_id for r in linededup.deduplicated(docs).collect() if r.n_lines_removed == 0 or r.n_lines > r.n_lines_removed}
        elif name == "near dedup":
            sets = {i: neardup.shingles_of(r.text, 5) for i, r in before.items()}
            links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0}
            least = {i: i for i in sets}
            while any(least[a] != least[b] for a, b in links):
                for a, b in links:
                    least[a] = least[b] = min(least[a], least[b])
            want = {i for i in sets if least[i] == i}
        else:
            items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            want = {i for i, r in before.items() if not any(x in " ".join(r.text.split()) for x in items)}
        assert set(left) == want, name
        assert all(r.n_chars == len(r.text) for r in left.values())
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in pieces} == set(left)
    assert corpus_pipeline.run(spark, SMALL).count() == len(pieces)
    assert decontaminate.Q == 8 and packing.WINDOW == 4096
