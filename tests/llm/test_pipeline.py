"""Each pipeline stage against brute force, and the whole."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexspark.llm import pii_crf, queries
from tests.llm.test_llm_operators import ODD, brute_components, brute_fingerprint, brute_hits, brute_quality, check_packing


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = lambda df: sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=str)
    now = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows(now)
        now = stage(spark, now, sf).cache()
        if k < 4:
            assert now.columns == docs.columns and now.dtypes == docs.dtypes
        if k == 0:
            assert set(rows(now)) <= {x for x in before if not brute_quality(x[1])[-1]}
            assert len(rows(now)) > 0.7 * len(before)
        elif k == 1:
            roots = brute_components([brute_fingerprint(t) for _, t in before])
            least = {}
            for x, r in zip(before, roots, strict=True):
                least[r] = min(least.get(r, x), x)
            assert rows(now) == sorted(least.values(), key=str)
        elif k == 2:
            items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
            bad = {r[0] for r in brute_hits(before, items) if r[-1]}
            assert bad and rows(now) == [x for x in before if x[0] not in bad]
        elif k == 3:
            assert [x[0] for x in rows(now)] == [x[0] for x in before]
            assert not any(pii_crf.base_spans(t) for _, t in rows(now))
            assert now.where(F.length("text") != F.col("n_chars")).count() == 0
        else:
            check_packing([r.asDict() for r in now.collect()], before)
    assert corpus_pipeline.run(spark, sf).count() == now.count()


@pytest.mark.parametrize("n", [len(ODD), 0])
def test_stages_on_odd_rows(spark, sf, n):
    rows = [(i, t, None, None, None, "q") for i, t in ODD[:n]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __quality string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns[-1] == "__quality"
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()


def test_all_operators_are_registered(spark, sf):
    import __spark_entry__

    names = __spark_entry__.queries()
    assert [len([x for x in names if x.startswith(f"op{n}_")]) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(queries.ORACLES) <= set(names)
