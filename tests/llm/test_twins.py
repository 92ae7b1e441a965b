"""Queries against their SQL twins, and the pipeline from end to end, on the smallest given tables."""

import os
from collections import Counter

import parity
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paritas.llm import line_dedup, mixing, near_dedup, packing, quality_rules
from paritas.llm.queries import QUERIES, TWINS

SF = os.path.join(parity.DATA, "sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    return parity.connect(SF)


@pytest.mark.parametrize("key", sorted(TWINS))
def test_query_equals_twin(spark, con, key):
    assert parity.difference(spark, con, key, QUERIES[key], TWINS[key], SF) is None


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_pipeline_is_its_operators_in_order(spark, documents):
    docs, counts = documents, [documents.count()]
    for step in (quality_rules.clean, line_dedup.dedup_lines, near_dedup.keep_one, mixing.mix):
        docs = spark.createDataFrame(step(docs).collect(), documents.schema)
        counts.append(docs.count())
    want = Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packing.pack(docs).collect())
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in got) == want
    assert 0 < counts[3] < counts[1] < counts[0]


def test_stages_keep_the_columns_and_take_awkward_rows(spark, odd, nothing):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns, name
        assert stage(spark, nothing, SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, odd, SF).where(F.col("length") > 2048).count() == 0
