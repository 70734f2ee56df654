"""Vocabulary counts over streams of documents and events; an addition, since the batch engine needs no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions.text import words


def read_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def running_types(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """Occurrences of each (word, lang) so far; the state is one row a type."""
    return docs.select(lang, F.explode(words(F.col(text))).alias("word")).groupBy(lang, "word").agg(F.count("*").alias("book_count"))


def windowed_counts(events: DataFrame, ts: str, key: str, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts in windows of event time; rows later than `late` behind the newest are left out, so old windows leave the state."""
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    counted = timed.groupBy(F.window("__ts", length), key).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), key, "n")


def new_documents(docs: DataFrame, id_col: str, ts: str, late: str) -> DataFrame:
    """Each document once within the watermark."""
    return docs.withWatermark(ts, late).dropDuplicatesWithinWatermark([id_col])
