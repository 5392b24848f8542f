"""The pipeline's stages on odd input, and the whole of it against brute force."""

import corpus_pipeline as pipeline
from anchorage.llm import jaccard, suffixes
from tests.llm.test_operators import dedup_by_force, jaccard_by_force

DATA = "/root/testdata/sf0.001"


def test_stages_keep_columns_on_odd_and_empty_input(spark, docs, nothing):
    for name, stage in pipeline.STAGES[:-1]:
        for table in (docs, nothing):
            found = stage(spark, table, DATA)
            assert found.columns == docs.columns and dict(found.dtypes) == dict(docs.dtypes), name
            rows = found.collect()
            assert bool(rows) == (table is docs)
            assert all(r["_id"] in ("x", None) and r["score"] in ("y", None) for r in rows)
    _, last = pipeline.STAGES[-1]
    assert last(spark, nothing, DATA).collect() == [] and last(spark, docs, DATA).count() >= docs.count()


def test_near_duplicates_leave_one_of_each_group(spark, docs, corpus):
    want = {g for i, _, _, g in jaccard_by_force(corpus)}
    rows = pipeline.near_duplicates(spark, docs, DATA).collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(want)
    assert sum(r.doc_id is None for r in rows) == 1


def test_whole_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = spark.createDataFrame(stage(spark, docs, DATA).collect(), docs.schema)
        after = {r.doc_id: r.text for r in docs.collect()}
        if stage is pipeline.near_duplicates:
            assert sorted(after) == sorted({g for _, _, _, g in jaccard_by_force(before)})
        if stage is pipeline.repeated_passages:
            lost = sum(r[2] * n for r, n in dedup_by_force(before, 50).items())
            size = lambda rows: sum(len((t or "").encode()) for t in rows)
            assert size(t for _, t in before) - size(after.values()) >= lost
        assert 0.7 * len(before) <= len(after) <= len(before), name
    rows = pipeline.run(spark, DATA).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert jaccard.join(docs).where("n_links > 0").count() == 0
    assert suffixes.dedup(docs).where("n_removed > 0").count() <= 3  # what a cut brings together
