"""Positioned tokens, types and phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions.text import words

#: Frequent words that are no content.
STOP = ("the", "and", "that", "was", "for", "with", "this", "are", "have", "from", "not", "you", "his", "her")


def tokens(texts: DataFrame, id_col: str, text_col: str, *keep: str) -> DataFrame:
    """(id, keep..., pos from 0, word)."""
    return texts.select(id_col, *keep, F.posexplode(words(F.col(text_col))).alias("pos", "word"))


def content_only(rows: DataFrame, word: str = "word") -> DataFrame:
    return rows.where((F.length(word) >= 3) & ~F.col(word).isin(*STOP))


def types(rows: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Occurrences and documents of each type; both are combined before the shuffle."""
    per_doc = rows.groupBy(*keys, id_col).agg(F.count("*").alias("n"))
    return per_doc.groupBy(*keys).agg(F.sum("n").alias("book_count"), F.count("*").alias("dispersion"))


def surfaces(rows: DataFrame, keys: list[str], surface: str) -> DataFrame:
    """The sorted distinct spellings of each type."""
    distinct = rows.select(*keys, surface).distinct()
    return distinct.groupBy(*keys).agg(F.array_sort(F.collect_list(surface)).alias("surface_forms"))


def first_occurrence(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The first row of each key; a min over a struct combines before the shuffle, a window doesn't."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    return rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("f")).select(*keys, "f.*")


def array_grams(texts: DataFrame, word_array: str, n: int, *keep: str) -> DataFrame:
    """(keep..., pos, gram) of the runs of n words of an array column: shifted copies are zipped, so no shuffle and no look-up by place."""
    size = F.size(word_array)
    shifted = [F.slice(word_array, k + 1, F.greatest(size - k, F.lit(0))).alias(f"w{k}") for k in range(n)]
    rows = texts.select(*keep, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "z")).where(f"z.w{n - 1} IS NOT NULL")
    return rows.select(*keep, "pos", F.concat_ws(" ", *[f"z.w{k}" for k in range(n)]).alias("gram"))


def gapped(texts: DataFrame, id_col: str, word_array: str, first: str, second: str, slop: int = 2) -> DataFrame:
    """(id, start, end): pairs of two words with at most `slop` others between; from each first word the next slop + 1 are looked at, without a shuffle."""
    size = F.size(word_array)
    ahead = [F.slice(word_array, k + 1, F.greatest(size - k, F.lit(0))).alias(f"w{k}") for k in range(slop + 2)]
    places = texts.select(id_col, F.posexplode(F.arrays_zip(*ahead)).alias("start", "z")).where(F.col("z.w0") == first)
    ends = F.array_compact(F.array(*[F.when(F.col(f"z.w{k}") == second, F.col("start") + k) for k in range(1, slop + 2)]))
    return places.select(id_col, "start", F.explode(ends).alias("end"))


def corpus_frequency(grams: DataFrame, id_col: str, total: DataFrame) -> DataFrame:
    """Count, documents and occurrences per million; total has one row with n."""
    counted = types(grams, ["gram"], id_col)
    return counted.crossJoin(F.broadcast(total)).withColumn("per_million", F.col("book_count") * 1e6 / F.col("n")).drop("n")
