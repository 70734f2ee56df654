"""Counting where texts are read against the stages over tables, which move every occurrence."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark import run
from lexspark.operators import counted, senses, spans, units
from lexspark.plans import vocabulary as V
from lexspark.plans.catalogue import ORACLES, QUERIES
from tests.test_queries import normal

SHOWN = ["canonical_form", "unit_type", "pos", "sense_id", "book_count", "dispersion", "confidence", "needs_review", "zipf_need", "fr_opacity", "sense_surprise", "score_default"]
ODD = [
    (7, "Runners İdle at K2 and Kelvin; naïve café élan x.\n  \nThe runners, xylo xylos!\r\nred green blue  red GREEN blue"),
    (8, None), (9, ""), (10, "\n\n"), (11, "!!! ..."), (12, "red green blue green blue red red green"), (13, "all rights reserved painters\nPainters paint. painter"),
    (-5, "makers makers makings\nfamous hopeful quickly"), (-6, "word " * 3000 + "\nmaker"), (14, "painters painters\tpainter's"),
]
TWICE = [(20, "Painter red green blue\nmaker"), (20, "painter dreams\nother maker makers"), (None, "painter lost red green blue"), (None, "lost makers")]


def shuffled(spark):
    """Rows shuffled so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    found = store.stageList(None, False, False, none, None)
    return sum(found.apply(k).shuffleWriteRecords() for k in range(found.size()))


def tables(spark, folder, docs):
    spark.createDataFrame([(i, t, "en", "web") for i, t in docs], "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "Red green blue red."), (2, "green blue red green"), (3, None), (4, "word")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 0, "the painter painted famous makers"), (2, 0, "idle " * 70)], "conv_id long, turn int, text string").write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def shown(rows):
    return normal(SHOWN, rows.withColumn("pos", F.coalesce("pos", F.lit("-"))).withColumn("confidence", F.round("confidence", 6)).select(SHOWN).withColumns({c: F.round(c, 6) for c in SHOWN[8:]}).collect())


def test_occurrences_are_not_shuffled(spark, tmp_path):
    rng = random.Random(1)
    told = [f"{a}{b}" for a in ("maker", "paint", "hope", "fame") for b in ("s", "ed", "ful", "ly", "ous", "ing")]
    sf = tables(spark, tmp_path, [(i, "\n".join(" ".join(rng.choices(told, k=20)) for _ in range(40))) for i in range(30)])
    began = shuffled(spark)
    QUERIES["q_vocabulary"](spark, sf).collect()
    small = shuffled(spark) - began
    run.composed(V.resources(spark, sf)).collect()
    assert small < 30 * 40 * 20 / 4 and shuffled(spark) - began - small > 30 * 40 * 20


@pytest.mark.parametrize("docs", [ODD, ODD + TWICE, TWICE, []], ids=["odd", "shared", "only shared", "none"])
def test_vocabulary_of_odd_texts(spark, tmp_path, docs):
    sf = tables(spark, tmp_path, docs)
    got = shown(QUERIES["q_vocabulary"](spark, sf))
    assert got == shown(run.composed(V.resources(spark, sf)))
    assert bool(got) == bool(docs)


def test_vocabulary_of_odd_texts_as_sql(spark, tmp_path):
    sf = tables(spark, tmp_path, [(i, t and t.replace("\r", "")) for i, t in ODD])
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet/*.parquet'")
    found = c.execute(ORACLES["q_vocabulary"])
    columns = [d[0] for d in found.description]
    rows = QUERIES["q_vocabulary"](spark, sf)
    assert normal(rows.columns, rows.collect()) == normal(columns, found.fetchall())


def test_parts_in_units(spark, tmp_path, monkeypatch):
    """However the lines of a task are cut into units."""
    sf = tables(spark, tmp_path, ODD)
    whole = shown(QUERIES["q_vocabulary"](spark, sf))
    monkeypatch.setattr(counted, "UNIT_BYTES", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        assert shown(QUERIES["q_vocabulary"](spark, sf)) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_merged_units_count_a_segment_once(spark, tmp_path):
    """Corrections that lead several words to one unit, alone and to a unit that another word has."""
    sf = tables(spark, tmp_path, [(3, "maker paints painter\nmaker maker\nhopeful painter"), (6, "maker painter\nfamous hopeful"), (12, "painter"), (21, "maker hopeful painter"), *TWICE])
    given = V.resources(spark, sf)
    every = [("maker", "n", f"maker.n.0{n}") for n in (1, 2, 3)] + [("painter", "n", f"painter.n.0{n}") for n in (1, 2, 3)] + [("hopeful", "a", f"hopeful.a.0{n}") for n in (1, 2, 3)]
    given["corrections"] = spark.createDataFrame([(*k, "paint", "n", "paint.n.01", None, None) for k in every], run.RESOURCES["corrections"])
    rules, idioms = V.RULES, [r.idiom for r in spans.lexicalised(given["expressions"]).collect()]
    ask = lambda wanted=None: run.counts(given["texts"], rules, idioms, lambda some: V.resources(spark, sf, some), wanted)
    got = shown(run.counted_vocabulary(given, counted.summed(ask()), V._told, ask))
    assert got == shown(run.composed(given))
    merged = [dict(zip(sorted(SHOWN), r, strict=True)) for r in got if "paint.n.01" in r]
    assert len(merged) == 1 and merged[0]["dispersion"] < merged[0]["book_count"]


def test_decide(spark):
    rng = random.Random(5)
    for k in (1, 2, 4):
        rows, asked = [], []
        for i in range(200):
            scores = [(rng.choice([0.0, 0.1, 0.3, 0.5]), rng.choice([0.0, 0.0, 0.3])) for _ in range(k)]
            rows += [(i, f"s{n}", n, *s) for n, s in enumerate(scores, 1)]
            asked.append((rng.choice([-1, 0, 1, 2, 9]), rng.choice([0.5, 0.6, 0.9])))
        c = spark.createDataFrame(rows, "id int, synset string, n int, gloss_score double, fr_score double")
        a = spark.createDataFrame([(i, senses.NO_SENSE if s == 0 else f"s{s}", f) for i, (s, f) in enumerate(asked) if s >= 0], "id int, selected string, confidence double")
        expected = {r.id: (r.best_sense, r.needs_review) for r in senses.analyse_occurrences(c, a, ["id"]).collect()}
        gloss, french = (np.array([r[j] for r in rows]).reshape(-1, k) for j in (3, 4))
        best, review = counted.decide(gloss, french, np.array([s for s, _ in asked]), np.array([f for _, f in asked]))
        assert {i: (f"s{b}" if b else senses.NO_SENSE, bool(r)) for i, (b, r) in enumerate(zip(best.tolist(), review.tolist(), strict=True))} == expected


def test_expressions_of_several_lengths(spark):
    idioms = ["give up", "give up now", "up now or", "a b c d", "b c", "one"]
    lines = ["give up now or never", "a b c d b c", "give", "up give up", "a b c", ""]
    segments = spark.createDataFrame([(k, "dialogue", t) for k, t in enumerate(lines)], "segment long, kind string, en string")
    rows = counted.summed(counted.parts(segments.coalesce(1), V.RULES, idioms)).where("kind = 'expression'")
    sure = spark.createDataFrame([(i, "idiome", 0.9) for i in idioms], "idiom string, label string, confidence double")
    t = run.expression_spans({"segments": segments, "expressions": sure})
    assert sorted((r.word, r.n, r.dispersion) for r in rows.collect()) == sorted((r.idiom, r.n, r.d) for r in t.groupBy("idiom").agg(F.count("*").alias("n"), F.count_distinct("segment").alias("d")).collect())


def test_forms_as_the_table():
    con = duckdb.connect()
    forms = "dogs less is a xylems xing friendly famous hopeful red things bed lying s xs ings".split()
    con.execute("create table f as select unnest(?) as form", [forms])
    expected = con.execute(f"select form, {V.LEMMA}, {V._duck(V.UPOS)} from f").fetchall()
    assert [(f, *V._form(f)) for f in forms] == expected
    assert V._form("é") is None and V._form("a1") is None and V._form("A") is None and V._form("") is None


def test_units_are_scored_alike(spark):
    empty = spark.createDataFrame([], run.RESOURCES["store"])
    per = spark.createDataFrame([("give up", ("idiome", 0.9), ["give up"], 2, 1)], "idiom string, f struct<label: string, confidence: double>, surface_forms array<string>, book_count long, dispersion long")
    e = units.scored_expressions(per, spark.createDataFrame([("give up", "stop")], "idiom string, definition string"), units.official(empty)).first()
    assert (e.sense_id, e.book_count, e.dispersion, e.definition_en) == ("idiome", 2, 1, "stop")
