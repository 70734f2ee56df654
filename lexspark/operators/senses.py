"""Sense candidates: evidence, ranks, margins and flags; contexts and samples of occurrences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Scalar product of two float arrays, in doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def context(rows: DataFrame, group: str, order: str, text: str, around: int = 2) -> DataFrame:
    """The text of the rows around each row, joined by blanks, with the row's own place in it."""
    w = W.partitionBy(group).orderBy(order)
    span = w.rowsBetween(-around, around)
    before = w.rowsBetween(-around, -1)
    joined = F.array_join(F.collect_list(text).over(span), " ")
    start = F.coalesce(F.sum(F.length(text) + 1).over(before), F.lit(0))
    return rows.withColumn("context", joined).withColumn("start", start).withColumn("end", F.col("start") + F.length(text))


def diverse(rows: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """k rows of each key, evenly spread over its order: those at floor(i n / k)."""
    w = W.partitionBy(*keys)
    marked = rows.withColumn("__at", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__n", F.count("*").over(w))
    wanted = F.array(*[F.floor(F.lit(i) * F.col("__n") / k) for i in range(k)])
    return marked.where(F.array_contains(wanted, F.col("__at").cast("bigint"))).drop("__at", "__n")


def evidence(hits: DataFrame, context_keys: list[str], base: float = 1.0, claimed: float = 0.15) -> DataFrame:
    """Score of each candidate: the best of its hits, each worth base over the number of candidates that share its key, less if another word explains it."""
    sharing = F.count("*").over(W.partitionBy(*context_keys, "hit_key"))
    worth = base / sharing * F.when(F.col("claimed"), claimed).otherwise(1.0)
    return hits.withColumn("worth", worth).groupBy(*context_keys, "candidate").agg(F.max("worth").alias("fr_score"))


def best_and_margin(scored: DataFrame, keys: list[str], candidate: str, score: str) -> DataFrame:
    """The best candidate and its lead over the second, 1 where there is none."""
    top = F.slice(F.sort_array(F.collect_list(F.struct(F.col(score).alias("s"), F.col(candidate).alias("c"))), asc=False), 1, 2)
    out = scored.groupBy(*keys).agg(top.alias("t"), F.count("*").alias("n_candidates"))
    first, second = F.get("t", F.lit(0)), F.get("t", F.lit(1))
    return out.select(*keys, "n_candidates", first["c"].alias("best"), first["s"].alias("best_score"), F.when(second.isNull(), 1.0).otherwise(first["s"] - second["s"]).alias("margin"))


def needs_arbitration(margin: Column, all_zero: Column, disagree: Column, low: float = 0.15) -> Column:
    return (margin < low) | all_zero | disagree


def cumulative_share(counts: DataFrame, keys: list[str], count: str, tie: str) -> DataFrame:
    w = W.partitionBy(*keys)
    run = w.orderBy(F.desc(count), tie).rowsBetween(W.unboundedPreceding, 0)
    return counts.withColumn("share", F.col(count) / F.sum(count).over(w)).withColumn("cumulative", F.sum(count).over(run) / F.sum(count).over(w))


def dominant(counts: DataFrame, keys: list[str], value: str, count: str) -> DataFrame:
    """The most frequent value of each key, the smallest of equals."""
    best = F.min(F.struct((-F.col(count)).alias("n"), F.col(value).alias("v"))).alias("b")
    return counts.groupBy(*keys).agg(best).select(*keys, F.col("b.v").alias(value), (-F.col("b.n")).alias(count))


#: The answer that no sense fits, and the confidence below which a choice is looked at again.
NO_SENSE = "aucun_sens_adapte"
LOW_CONFIDENCE = 0.6


def analyse_occurrences(candidates: DataFrame, arbitration: DataFrame, keys: list[str], low: float = 0.15) -> DataFrame:
    """The sense of each occurrence, from its candidates (keys, synset, n, gloss_score, fr_score), n their order in the inventory.

    The final score is the sum of both. Close or empty scores, or gloss and French evidence that prefer different senses,
    ask for arbitration (keys, selected, confidence): a choice out of the inventory is looked at again if it isn't confident;
    that no sense fits, or no usable answer, is always looked at.
    """
    final = F.col("gloss_score") + F.col("fr_score")
    first = lambda score: F.max_by(F.when(F.col(score) != 0, F.col("synset")), F.when(F.col(score) != 0, F.struct(score, -F.col("n"))))
    ranked = F.sort_array(F.collect_list(F.struct(F.col("final").alias("s"), (-F.col("n")).alias("k"), "synset")), asc=False)  # as long as a word's inventory
    one = candidates.withColumn("final", final).groupBy(*keys).agg(
        ranked.alias("r"), F.bool_and(F.col("final") == 0).alias("all_zero"), first("gloss_score").alias("gloss_best"), first("fr_score").alias("fr_best")
    )
    second = F.get("r", F.lit(1))["s"]
    rows = one.withColumns({
        "margin": F.when(second.isNull(), 1.0).otherwise(F.get("r", F.lit(0))["s"] - second),
        "disagreement": F.coalesce(F.col("gloss_best") != F.col("fr_best"), F.lit(False)),
        "top": F.get("r", F.lit(0))["synset"],
        "inventory": F.transform("r", lambda x: x["synset"]),
    })
    asked = rows.withColumn("asked", needs_arbitration(F.col("margin"), F.col("all_zero"), F.col("disagreement"), low)).join(arbitration, keys, "left")
    usable = F.col("asked") & F.coalesce(F.array_contains("inventory", F.col("selected")), F.lit(False))
    none = F.col("asked") & F.coalesce(F.col("selected") == NO_SENSE, F.lit(False))
    return asked.select(
        *keys, "inventory", "margin", "all_zero", "disagreement", "asked",
        F.when(usable, F.col("selected")).when(none, NO_SENSE).otherwise(F.col("top")).alias("best_sense"),
        F.when(~F.col("asked"), False).when(usable, F.coalesce("confidence", F.lit(0.0)) < LOW_CONFIDENCE).otherwise(True).alias("needs_review"),
    )


def claimed_stems(rows: DataFrame, french: DataFrame) -> DataFrame:
    """(rows' columns, claimed): the stems of the word itself, and of all French words (word, fr) of the sentence's other content words.

    rows has id, word and en.
    """
    from lexspark.functions.text import content_words, fr_stem

    others = rows.select("id", F.explode(content_words(F.col("en"), F.col("word"))).alias("other"))
    stems = french.select(F.lower("word").alias("other"), fr_stem(F.col("fr")).alias("stem")).distinct()
    explained = others.join(stems, "other").groupBy("id").agg(F.collect_set("stem").alias("stems"))
    own = F.array(fr_stem(F.col("word")))
    joined = rows.join(explained, "id", "left")
    return joined.select(*rows.columns, F.array_sort(F.array_union(own, F.coalesce("stems", F.array().cast("array<string>")))).alias("claimed"))


def span_context(rows: DataFrame, spans: DataFrame, group: str, order: str, text: str, around: int = 2) -> DataFrame:
    """(span columns, context, start, end): the text of rows first to last of each span (group, first, last) with `around` more on each side."""
    near = rows.select(group, F.col(order).alias("__n"), F.col(text).alias("__t"))
    wide = spans.join(near, group).where(F.col("__n").between(F.col("first") - around, F.col("last") + around))
    parts = F.array_sort(F.collect_list(F.struct("__n", "__t")))
    text_of = lambda keep: F.array_join(F.transform(F.filter("parts", keep), lambda x: x["__t"]), " ")
    joined = wide.groupBy(*spans.columns).agg(parts.alias("parts"))
    before = text_of(lambda x: x["__n"] < F.col("first"))
    upto = text_of(lambda x: x["__n"] <= F.col("last"))
    start = F.when(F.exists("parts", lambda x: x["__n"] < F.col("first")), F.length(before) + 1).otherwise(0)
    return joined.select(*spans.columns, text_of(lambda x: x["__n"].isNotNull()).alias("context"), start.alias("start"), F.length(upto).alias("end"))


def expression_occurrences(units: DataFrame, spans: DataFrame, contexts: DataFrame) -> DataFrame:
    """(key, segment, context, target_surface) of expressions (canonical_form, label, segments); of several spans of one in a segment the last counts."""
    last = spans.groupBy("idiom", "segment").agg(F.max_by("surface", "start").alias("surface"))
    asked = units.select("canonical_form", F.concat_ws(":", F.lit("mwe"), "canonical_form", "label").alias("key"), F.explode("segments").alias("segment"))
    joined = asked.join(last.withColumnRenamed("idiom", "canonical_form"), ["canonical_form", "segment"], "left").join(contexts.where("context <> ''"), "segment")
    return joined.select("key", "segment", "context", F.coalesce("surface", "canonical_form").alias("target_surface"))


def first_target(tokens: Column, word: Column) -> Column:
    """The place from 0 of the first token that is the word, whatever its case; null if none is."""
    at = F.array_position(F.transform(tokens, F.lower), F.lower(word))
    return F.when(at > 0, at - 1)
