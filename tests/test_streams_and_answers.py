"""Streams against their batch counterparts; questions and answers."""

from collections import Counter

from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import answers as A
from lexspark.streaming import vocabulary as V


def drained(df, name, mode):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    return df.sparkSession.table(name)


def test_running_types(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = V.read_stream(spark, str(tmp_path / "in"), docs.schema.simpleString()[7:-1].replace(":", " "))
    got = {(r.lang, r.word): r.book_count for r in drained(V.running_types(stream), "types", "complete").collect()}
    assert got == {(r.lang, r.word): r.book_count for r in V.running_types(docs).collect()}


def test_windowed_counts(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    got = Counter({(r.start, r.event_type): r.n for r in drained(V.windowed_counts(stream, "ts", "event_type"), "hours", "append").collect()})
    batch = events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour"), "event_type").agg(F.count("*").alias("n")).collect()
    expected = {(r.window.start, r.event_type): r.n for r in batch}
    assert got and all(expected[k] == n for k, n in got.items())


def test_answers(spark):
    rows = spark.createDataFrame([("k1", ["dog"], "n", "an animal", ["a dog ran"]), ("k2", ["give up"], None, None, [])], "key string, lemmas array<string>, pos string, definition string, examples array<string>")
    asked = rows.select("key", A.translation_prompt(F.col("lemmas"), F.col("pos"), F.col("definition"), F.col("examples")).alias("prompt"))

    def client(prompts):
        if any("give up" in p for p in prompts):
            raise RuntimeError("no line")
        return ["chien"] * len(prompts)

    got = {r.key: r.answer for r in A.with_answers(asked, A.ask(asked, client, at_once=1)).collect()}
    assert got == {"k1": "chien", "k2": None}
    votes = spark.createDataFrame([("k", 1, "chien"), ("k", 2, "chat"), ("k", 3, "Chiens"), ("m", 1, "x"), ("m", 2, "y"), ("m", 3, " ")], "key string, n_asked int, answer string")
    assert [tuple(r) for r in A.vote(votes, T.fr_stem(F.col("answer"))).collect()] == [("k", "chien", 2)]
    said = spark.createDataFrame([("a", "s1"), ("b", None), ("c", "s9")], "key string, sense_id string")
    assert sorted(r.key for r in A.unusable(said, spark.createDataFrame([("a", "s1"), ("c", "s1")], "key string, sense_id string")).collect()) == ["b", "c"]
    kinds = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "kind string, key int")
    assert sorted((r.kind, r.batch) for r in A.numbered_batches(kinds, "kind", "key", 2).collect()) == [("a", 0), ("a", 0), ("a", 1), ("a", 1), ("a", 2), ("b", 0)]


def test_page_helpers(spark):
    df = spark.createDataFrame([("He <ran> away, RAN far", ["a", "b", "c", "d", "e", "f"], ["b", "c", "d", "e", "x"])], "t string, tokens array<string>, sentence array<string>")
    r = df.select(T.highlighted(F.col("t"), ["ran", "ran away"]).alias("h"), T.sentence_span(F.col("tokens"), F.col("sentence")).alias("s"), T.sentence_span(F.col("tokens"), F.array(F.lit("c"))).alias("one"), T.sentence_span(F.col("tokens"), F.array(F.lit("q"))).alias("no")).first()
    assert r.h == "He &lt;<mark>ran</mark>&gt; away, <mark>RAN</mark> far"
    assert tuple(r.s) == (1, 5) and tuple(r.one) == (2, 3) and r.no is None
