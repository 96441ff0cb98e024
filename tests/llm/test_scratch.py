from __future__ import annotations

import os

import pytest

import corpus_pipeline
from subscope.llm import common


def left_behind(spark, monkeypatch, step):
    """What a step returns, and the number of tables it leaves in the shared folder."""
    made: list[common.Scratch] = []
    before = common.Scratch.__init__

    def noted(self, session):
        before(self, session)
        made.append(self)

    monkeypatch.setattr(common.Scratch, "__init__", noted)
    rows = step().collect()
    return rows, sum(len(os.listdir(f)) for s in made if os.path.isdir(f := s.folder.removeprefix("file:")))


def test_stages_leave_only_what_their_result_reads(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        rows, tables = left_behind(spark, monkeypatch, lambda f=stage: f(spark, docs, sf_dir))
        assert rows and tables <= 3, (name, tables)


@pytest.mark.parametrize("limit", [0, 1 << 18])
def test_dropped_ids_with_and_without_broadcast(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "DROPPED_IDS", limit)
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (3, "e")], "doc_id long, text string")
    dropped = common.Scratch(spark).keep(spark.createDataFrame([(2,), (None,)], "k long"))
    assert sorted(r.text for r in common.without(docs, "doc_id", dropped).collect()) == ["a", "e"]
    assert common.without(docs, "doc_id", dropped.limit(0)).count() == 5
