"""Registered queries against their SQL, and the pipeline stage by stage."""

import os
import zlib

import numpy as np
import pytest

import corpus_pipeline
from clickstar.llm import queries
from clickstar.llm.tables import Scratch
from tests.compare import difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(llm, con, name):
    assert difference(queries.QUERIES[name](llm, SF_DIR), con, queries.SQL[name]) is None


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(llm, awkward, scratch):
    """Every stage keeps the columns and only its own decisions, down to the last sequence."""
    docs, held = llm.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = Scratch(llm, f"stage-{name}").keep(stage(llm, docs, SF_DIR), "out")
        held[name] = (docs, out)
        if name != "packing":
            assert out.columns == docs.columns
            extra = out.exceptAll(docs) if name != "mixing" else out.distinct().exceptAll(docs)
            assert extra.count() == 0
        docs = out
    before, after = held["ngram_join"]
    from tests.llm.brute import components

    rows = [(r.doc_id, r.text) for r in before.collect()]
    groups = {c for _, _, c in components(rows, 5, 80)}
    assert sorted(r.doc_id for r in after.collect()) == sorted(groups)
    before, after = held["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    sizes = [r["sum(length)"] for r in after.groupBy("sequence_id").sum("length").collect()]
    assert max(sizes) <= 4096 and sum(s < 4096 for s in sizes) <= 12 * 8


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_awkward_rows(llm, awkward, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(llm, awkward, SF_DIR).count() > 0
    assert stage(llm, awkward.where("false"), SF_DIR).count() == 0


def test_pipeline_gives_the_token_ids(llm, awkward):
    rows = dict(corpus_pipeline.STAGES)["packing"](llm, awkward, SF_DIR).collect()
    assert rows
    for r in rows:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    assert "ids" in corpus_pipeline.run(llm, SF_DIR).columns


def test_run_gives_the_last_stage(llm):
    assert "sequence_id" in corpus_pipeline.run(llm, SF_DIR).columns


def test_op1_gives_the_packed_ids(llm):
    rows = queries.QUERIES["op1_packing"](llm, SF_DIR).where("doc_id < 40").collect()
    assert len({r.doc_id for r in rows}) == 40
    for r in rows:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
