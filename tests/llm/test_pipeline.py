"""Registered queries and the pipeline on the smallest sample."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from gridwarden.llm.oracles import llm_oracles
from gridwarden.llm.queries import llm_queries

from .test_corpus import brute_contamination, brute_groups


@pytest.mark.parametrize("name", list(llm_oracles()))
def test_against_sql(spark, sample_dir, name):
    connection = duckdb.connect()
    for path in Path(sample_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = entry_points.queries()[name](spark, sample_dir)
    cursor = connection.execute(llm_oracles()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted(repr([r[c] for c in sorted(names)]) for r in df.collect())
    assert got == sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in cursor.fetchall()) and got


def test_registered():
    assert set(llm_queries()) | {"pipeline"} <= set(entry_points.queries())
    assert [n.split("_")[0] for n in llm_queries()] == [f"op{i}" for i in range(1, 14)]


def test_pipeline(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], sample_dir))
        if len(kept) <= len(corpus_pipeline.STAGES):
            assert kept[-1].columns == docs.columns
            kept[-1] = kept[-1].checkpoint()
    ids = [[r["doc_id"] for r in df.select("doc_id").collect()] for df in kept[:-1]]
    assert set(ids[1]) < set(ids[0]) and len(ids[1]) == len(set(ids[1]))
    # near copies: exactly the smallest id of each group
    rows = [(r["doc_id"], r["text"], "") for r in kept[1].collect()]
    assert sorted(ids[2]) == sorted({c for _, c in brute_groups(rows, 5, 80, 100).values()})
    # benchmark: exactly the clean ones
    items = [tuple(r) for r in spark.read.parquet(f"{sample_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r["doc_id"], r["text"], "") for r in kept[2].collect()]
    assert sorted(ids[3]) == sorted(x[0] for x in brute_contamination(rows, items) if not x[5])
    assert set(ids[4]) <= set(ids[3]) and max(ids[4].count(i) for i in set(ids[4])) <= 2
    segments = kept[-1].selectExpr("explode(arrays_zip(seg_doc, seg_start)) as s").where("s.seg_start = 0")
    assert sorted(r["s"]["seg_doc"] for r in segments.collect()) == sorted(ids[4])
    assert corpus_pipeline.run(spark, sample_dir).count() == kept[-1].count()


ODD_STAGES = corpus_pipeline.STAGES[:-1]


def test_odd_rows_through_every_stage(spark, sample_dir, make_docs, odd_rows):
    """Each stage alone on rows with nulls, blanks, repeats and clashing names, and on none."""
    docs = make_docs(odd_rows).withColumnRenamed("key", "_quality").checkpoint()
    given = sorted(map(repr, docs.collect()))
    for name, stage in ODD_STAGES:
        out = stage(spark, docs, sample_dir)
        assert out.columns == docs.columns, name
        rows = [repr(r) for r in out.collect()]
        if name == "mix":  # documents without words take no room, others at most two
            assert set(rows) <= set(given) and all(rows.count(r) <= 2 * given.count(r) for r in rows)
        elif name == "near_copies":
            # 1 and 7 have one text; of the rows of 7 none stays, and the row without id and the empty ones do
            kept = sorted(repr(r["doc_id"]) for r in out.collect())
            assert kept == sorted(map(repr, [1, None, 2, 3, 4, 5, 6, 8]))
        elif name == "benchmark":
            assert sorted(rows) == given  # nothing of the benchmark occurs
        else:
            assert set(rows) <= set(given)
        assert stage(spark, docs.limit(0), sample_dir).collect() == [], name
    packed = corpus_pipeline.packed(spark, docs, sample_dir)
    seen = packed.selectExpr("explode(seg_doc) as d").distinct().collect()
    assert {r["d"] for r in seen} >= {1, 5, 6, 7, 8}
    assert corpus_pipeline.packed(spark, docs.limit(0), sample_dir).collect() == []
