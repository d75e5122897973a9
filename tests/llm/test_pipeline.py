"""The corpus pipeline, stage by stage on the small fixture, and its registration."""

import __spark_entry__ as E
import corpus_pipeline
from cargoline.llm.common import land
from tests.conftest import SF_SMALL


def test_stages_keep_columns_and_take_effect(spark, docs, none):
    for start in (docs, none):
        now = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = land(stage(spark, now, SF_SMALL), "stage")
            assert after.columns == start.columns, name
            assert after.count() <= now.count()
            now = after
        pieces = corpus_pipeline.STAGES[-1][1](spark, now, SF_SMALL)
        assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in now.select("doc_id").collect()}


def test_all_queries_are_registered():
    names = set(E.queries())
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
