"""Row-by-row steps hold arrays of a small slice of a batch, however large the batch."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from eventide.llm import decontaminate, minhash_bayes, quality_cascade
from tests.llm.fixtures import prose

ROWS = 5000


class Batches:
    """Stands for documents; what a task would run over one large batch is run here."""
    columns, schema = ["doc_id", "text"], None

    def __init__(self, batch):
        self.batch, self.rows = batch, 0

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        self.rows = sum(b.num_rows for b in run([self.batch]))
        return self


class Shared:
    value = np.full(4096, 255, np.uint8)


@pytest.fixture(scope="module")
def batch():
    texts = [prose(i, 400) for i in range(20)]
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(range(ROWS)), "text": [texts[i % 20] for i in range(ROWS)]})


@pytest.mark.parametrize("step", [
    lambda d: quality_cascade.kept_rows(d),
    lambda d: quality_cascade.judge(d, counts=True),
    lambda d: minhash_bayes._signed(d, 5, 16),
    lambda d: decontaminate._with_seeds(d, decontaminate.MASKS, Shared)], ids=["kept_rows", "judge", "signed", "seeds"])
def test_arrays_follow_a_slice(spark, monkeypatch, batch, step):
    monkeypatch.setattr(quality_cascade, "estimate", lambda *a: [(r.name, 1.0, 0.0) for r in quality_cascade.RULES])
    docs = Batches(batch)
    tracemalloc.start()
    try:
        step(docs)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert docs.rows == ROWS
    assert most < 100 << 20, f"{most >> 20} MB for {batch.nbytes >> 20} MB of rows"
