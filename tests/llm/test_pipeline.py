"""The pipeline's stages against what each operator says about its own input."""

import collections

import corpus_pipeline
from forumflow.llm import decontaminate, jaccard, quality
from forumflow.llm.staging import staged, table


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    before, inputs = docs, []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(before)
        after = staged(stage(spark, before, sf_dir), "stage")
        before = after
    ids = [sorted(r[0] for r in d.select("doc_id").collect()) for d in [*inputs, after]]
    assert all(d.columns == columns for d in inputs)
    assert ids[1] == sorted(r.doc_id for r in quality.document_quality(inputs[0]).filter("kept").collect())
    assert ids[2] == ids[1]
    groups = collections.defaultdict(list)
    for r in jaccard.near_duplicates(inputs[2]).collect():
        groups[r.class_id].append(r.doc_id)
    assert ids[3] == sorted(min(g) for g in groups.values())
    clean = decontaminate.contamination(inputs[3], table(spark, sf_dir, "benchmark"), ["doc_id"])
    assert ids[4] == sorted(r.doc_id for r in clean.filter("not contaminated").collect())
    assert sorted(set(ids[5])) == ids[4]


def test_no_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage")
    assert docs.count() == 0
