"""The pipeline's stages one by one on small data, and its chain."""

from collections import Counter

import corpus_pipeline as cp
from eventide.llm import curriculum, queries
from tests.llm.fixtures import frame, texts
from tests.oracle_harness import canon, duck
import pytest


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_sql(spark, sf_dir, key):
    got = queries.QUERIES[key](spark, sf_dir).toPandas()
    assert canon(got) == canon(duck(sf_dir).sql(queries.ORACLE[key]).df())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in cp.STAGES[:3]:
        out = stage(spark, docs, sf_dir)
        rows = out.collect()
        assert out.columns == docs.columns and all(before[r.doc_id] == r for r in rows) and 0 < len(rows) < len(before)
        before = {r.doc_id: r for r in rows}
        docs = spark.createDataFrame(rows, docs.schema)


def test_chain(spark, sf_dir):
    rows = cp.run(spark, sf_dir).collect()
    assert rows and sorted(r.start for r in rows)[0] == 0
    assert sum(r.n_tokens for r in rows) == max(r.start + r.n_tokens for r in rows)


def test_store_keeps_training_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in cp.STAGES[:3]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
    want = sorted((c.position, r.key, r.doc_id) for r in curriculum.mix(docs).collect() for c in r.copies if 2 * c.words >= r.size)
    rows = sorted(cp.run(spark, sf_dir).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [i for _, _, i in want] != sorted(i for _, _, i in want)
    assert [r.place for r in rows] == list(range(len(rows)))


def test_stages_take_awkward_rows(spark, sf_dir):
    docs = frame(spark)
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == frame(spark).columns
    empty = frame(spark, [])
    for name, stage in cp.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
    assert Counter(r.doc_id for r in cp.quality_rules(spark, frame(spark), sf_dir).collect())[8] == 1
    assert len(texts()) > 40
