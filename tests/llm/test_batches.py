"""Batches handed to Python stay small, and results do not depend on where they end."""

import pyarrow as pa
import pytest

import corpus_pipeline
from clickstar.llm import packing
from clickstar.session import prepare

BYTES, ROWS = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"


def batch_bytes(batches):
    for batch in batches:
        yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_bound_batches_by_bytes(llm, stage):
    """Each stage by itself: 32 MB of texts reach a task in several batches."""
    llm.conf.unset(BYTES)
    docs = llm.createDataFrame([], "doc_id bigint, source string, text string, lang string")
    try:
        dict(corpus_pipeline.STAGES)[stage](llm, docs, "/root/testdata/sf0.001")
        wide = llm.range(0, 1600, 1, 1).selectExpr("id", "repeat('some word ', 2000) AS text")
        seen = wide.mapInArrow(batch_bytes, "n bigint, size bigint").collect()
    finally:
        prepare(llm)
    assert sum(r.n for r in seen) == 1600
    assert max(r.size for r in seen) < 6e6


def test_packing_does_not_depend_on_batches(llm):
    docs = llm.range(0, 5000, 1, 1).selectExpr(
        "id AS doc_id", "repeat('a word here ', cast(id * 37 % 300 AS int)) AS text")
    rows = llm.conf.get(ROWS)
    try:
        whole = sorted(map(tuple, packing.pack_documents(docs).collect()))
        llm.conf.set(ROWS, "700")
        assert sorted(map(tuple, packing.pack_documents(docs).collect())) == whole
    finally:
        llm.conf.set(ROWS, rows)
