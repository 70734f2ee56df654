"""Frequent runs by levels, against counting all of them."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.operators import grams, spans
from lexspark.operators import tokens as tok
from lexspark.functions import text as T
from lexspark.plans.catalogue import QUERIES


def plainly(docs, longest, least):
    """All places of all runs, gathered by id."""
    found = None
    for n in range(2, longest + 1):
        own = tok.array_grams(docs.select("doc_id", T.words(F.col("text")).alias("w")), "w", n, "doc_id")
        own = own.select("doc_id", F.col("pos").alias("start"), (F.col("pos") + n).alias("end"), F.col("gram").alias("label"))
        found = own if found is None else found.unionByName(own)
    often = found.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("label")
    return spans.select_spans(found.join(often, "label", "left_semi"), ["doc_id"])


@pytest.mark.parametrize("longest, least", [(2, 2), (3, 2), (4, 3)])
def test_greedy_frequent_spans(spark, monkeypatch, longest, least):
    monkeypatch.setattr(grams, "SLICE_BYTES", 200)  # many parts of a batch, many rounds of keys
    monkeypatch.setattr(grams, "KEYS", 50)
    rng = np.random.default_rng(longest)
    words = ["a", "B", "cat", "dö", "É", "x9y", "the", "Kelvin", "İ", "no--no", "\n", "日本", "."]
    texts = [" ".join(rng.choice(words, rng.integers(0, 40))) for _ in range(150)] + [None, "", " ", "...", "the", "a b"]
    ids = [*range(len(texts) - 6), None, None, 3, 3, 7, 7]  # ids that repeat, and two without one
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(5)
    got, want = grams.greedy_frequent_spans(docs, "doc_id", "text", longest, least), plainly(docs, longest, least)
    assert got.dtypes == want.dtypes
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert grams.greedy_frequent_spans(docs.where("text = ''"), "doc_id", "text", longest, least).count() == 0


def test_numbers():
    rng = np.random.default_rng(1)
    known = np.unique(rng.integers(0, 1 << 62, 20_000))
    asked = np.concatenate([known, rng.integers(0, 1 << 62, 20_000), known + 1])
    place = {k: i for i, k in enumerate(known.tolist())}
    assert grams._Numbers(known)(asked).tolist() == [place.get(k, -1) for k in asked.tolist()]
    assert grams._Numbers(known[:0])(asked[:3]).tolist() == [-1] * 3


def test_places_of_runs_are_not_shuffled(spark, sf):
    plan = QUERIES["q_greedy_spans"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(label" not in plan
