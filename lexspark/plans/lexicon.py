"""Types against lexical lookups: prevalence, levels, bands, units, ranks, tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexspark.functions import scores as S
from lexspark.functions import text as T
from lexspark.operators import select, store
from lexspark.operators import tokens as tok
from lexspark.plans.corpus import PASSAGES_SQL, doc_tokens, frequent_spans, passage_spans
from lexspark.plans.registry import WORDS_SQL, query, table


def type_stats(spark: SparkSession, sf: str) -> DataFrame:
    """(word, lang): counts, prevalence in the language's documents, zipf and level."""
    per_type = tok.types(doc_tokens(spark, sf), ["word", "lang"], "doc_id")
    langs = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n_docs"))
    totals = per_type.groupBy("lang").agg(F.sum("book_count").alias("total"))
    rows = per_type.join(langs, "lang").join(totals, "lang")  # a row for each language; adaptive execution sees the size
    z = S.zipf(F.col("book_count"), F.col("total"))
    return rows.select("word", "lang", "book_count", "dispersion", (F.col("dispersion") / F.col("n_docs")).alias("pknown"), z.alias("zipf")).withColumn("level", S.level(F.col("zipf")))


LEVEL_SQL = "CASE WHEN zipf >= 6 THEN 'A1' WHEN zipf >= 5.5 THEN 'A2' WHEN zipf >= 5 THEN 'B1' WHEN zipf >= 4.5 THEN 'B2' WHEN zipf >= 4 THEN 'C1' ELSE 'C2' END"
TYPES_SQL = f"""{WORDS_SQL},
t0 AS (SELECT word, lang, count(*) AS book_count, count(DISTINCT doc_id) AS dispersion FROM tok GROUP BY word, lang),
nd AS (SELECT lang, count(*) AS n_docs FROM documents GROUP BY lang),
tot AS (SELECT lang, sum(book_count) AS total FROM t0 GROUP BY lang),
t1 AS (SELECT word, t0.lang, book_count, dispersion, dispersion / n_docs AS pknown, log10(book_count / total * 1e9) AS zipf FROM t0 JOIN nd ON t0.lang = nd.lang JOIN tot ON t0.lang = tot.lang),
types AS (SELECT *, {LEVEL_SQL} AS level FROM t1)"""
NEED_SQL = "greatest(0, least(1, (6 - zipf) / 4))"
GAIN_SQL = "greatest(0, least(1, ln(1 + book_count) / ln(21)))"


@query(f"""WITH {TYPES_SQL} SELECT word, lang, CASE WHEN book_count >= 50 AND pknown < 0.20 THEN 'pknown' WHEN length(word) > 14 THEN 'named_entity' WHEN level IN ('A1', 'A2') THEN 'cefr' END AS drop_reason FROM types""")
def q_prevalence_gate(spark: SparkSession, sf: str) -> DataFrame:
    rows = type_stats(spark, sf)
    reason = select.drop_reason(F.col("pknown"), F.col("book_count"), F.length("word") > 14, F.array("level"), known_below=0.20)
    return rows.select("word", "lang", reason.alias("drop_reason"))


@query(f"""WITH {TYPES_SQL}, exact AS (SELECT word, lang, level FROM types WHERE book_count >= 20),
anyl AS (SELECT word, string_agg(level, '/' ORDER BY level) AS levels FROM (SELECT DISTINCT word, level FROM types WHERE book_count >= 5) GROUP BY word)
SELECT t.word, t.lang, coalesce(e.level, a.levels, '?') AS levels FROM types t LEFT JOIN exact e ON t.word = e.word AND t.lang = e.lang LEFT JOIN anyl a ON t.word = a.word""")
def q_cefr_fallback(spark: SparkSession, sf: str) -> DataFrame:
    types = type_stats(spark, sf)
    exact = types.where("book_count >= 20").select("word", "lang", F.col("level").alias("levels"))
    by_word = types.where("book_count >= 5").groupBy("word").agg(F.array_join(F.array_sort(F.collect_set("level")), "/").alias("levels"))
    found = select.with_fallback(types.select("word", "lang"), exact, by_word, "word", "lang", "levels")
    return found.withColumn("levels", F.coalesce("levels", F.lit("?")))


@query(f"""WITH {TYPES_SQL}, en AS (SELECT word, zipf FROM types WHERE lang = 'en'), known AS (SELECT word, round(zipf, 6) AS value FROM en WHERE length(word) BETWEEN 3 AND 9),
w AS (SELECT word, CASE WHEN regexp_matches(word, '(ing|ed|es|s)$') THEN regexp_replace(word, '(ing|ed|es|s)$', '') END AS base FROM en)
SELECT w.word, coalesce(a.value, b.value, -1.0) AS value, CASE WHEN a.value IS NOT NULL THEN 'exact' WHEN b.value IS NOT NULL THEN 'lemma' ELSE 'none' END AS source
FROM w LEFT JOIN known a ON a.word = w.word LEFT JOIN known b ON b.word = w.base""")
def q_exact_or_lemma(spark: SparkSession, sf: str) -> DataFrame:
    en = type_stats(spark, sf).where("lang = 'en'").select("word", "zipf")
    known = en.where("length(word) BETWEEN 3 AND 9").select(F.col("word").alias("k"), F.round("zipf", 6).alias("v"))
    base = F.when(F.col("word").rlike("(ing|ed|es|s)$"), F.regexp_replace("word", "(ing|ed|es|s)$", ""))
    rows = en.select("word", base.alias("base"))
    a, b = known.select(F.col("k").alias("word"), F.col("v").alias("exact")), known.select(F.col("k").alias("base"), F.col("v").alias("lemma"))
    source = F.when(F.col("exact").isNotNull(), "exact").when(F.col("lemma").isNotNull(), "lemma").otherwise("none")
    return rows.join(a, "word", "left").join(b, "base", "left").select("word", F.coalesce("exact", "lemma", F.lit(-1.0)).alias("value"), source.alias("source"))


def text_words(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return table(spark, sf, name).select(F.explode(T.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def words_sql(name: str) -> str:
    return f"(SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM {name}) GROUP BY word)"


@query(f"""WITH d AS {words_sql('documents')}, b AS {words_sql('benchmark')}, c AS {words_sql('conversations')}
SELECT d.word, coalesce(b.n, c.n, 0) AS n, CASE WHEN b.n IS NOT NULL THEN 'benchmark' WHEN c.n IS NOT NULL THEN 'conversations' END AS source
FROM d LEFT JOIN b ON d.word = b.word LEFT JOIN c ON d.word = c.word""")
def q_priority_lookup(spark: SparkSession, sf: str) -> DataFrame:
    sources = [(x, text_words(spark, sf, x)) for x in ("benchmark", "conversations")]
    return select.prioritised(text_words(spark, sf, "documents").select("word"), sources, "word", "n").fillna(0, ["n"])


EDGES = [0.0, 2.0, 3.0, 4.0, 4.5, 5.0, 6.0, 7.5]


@query(f"""WITH {TYPES_SQL}, dim(band, low, high) AS (VALUES (0,0.0,2.0),(1,2.0,3.0),(2,3.0,4.0),(3,4.0,4.5),(4,4.5,5.0),(5,5.0,6.0),(6,6.0,7.5),(7,7.5,1e9)),
c AS (SELECT band, count(*) AS n FROM types JOIN dim ON zipf >= low AND zipf < high WHERE lang = 'en' GROUP BY band)
SELECT dim.band, CAST(low AS DOUBLE) AS low, coalesce(n, 0) AS n, round(100.0 * coalesce(n, 0) / sum(coalesce(n, 0)) OVER (), 6) AS percent FROM dim LEFT JOIN c ON dim.band = c.band""")
def q_bands(spark: SparkSession, sf: str) -> DataFrame:
    return select.banded(type_stats(spark, sf).where("lang = 'en'"), "zipf", EDGES)


@query(f"""WITH {TYPES_SQL} SELECT lang, round(min(zipf), 6) AS low, round(max(zipf), 6) AS high, round(avg(zipf), 6) AS mean, round(median(zipf), 6) AS middle, count(*) AS n
FROM types WHERE zipf >= 3 AND zipf < 6 GROUP BY lang""")
def q_zipf_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = type_stats(spark, sf).where(select.half_open(F.col("zipf"), 3, 6))
    r = lambda c: F.round(c, 6)
    return rows.groupBy("lang").agg(r(F.min("zipf")).alias("low"), r(F.max("zipf")).alias("high"), r(F.avg("zipf")).alias("mean"), r(F.median("zipf")).alias("middle"), F.count("*").alias("n"))


@query(f"""WITH d AS {words_sql('documents')}, c AS {words_sql('conversations')}
SELECT coalesce(d.word, c.word) AS word, coalesce(d.n, 0) AS n_documents, coalesce(c.n, 0) AS n_conversations, coalesce(d.n, 0) - coalesce(c.n, 0) AS difference FROM d FULL JOIN c ON d.word = c.word""")
def q_count_compare(spark: SparkSession, sf: str) -> DataFrame:
    d = text_words(spark, sf, "documents").withColumnRenamed("n", "d")
    c = text_words(spark, sf, "conversations").withColumnRenamed("n", "c")
    n_d, n_c = F.coalesce("d", F.lit(0)), F.coalesce("c", F.lit(0))
    return d.join(c, "word", "full_outer").select("word", n_d.alias("n_documents"), n_c.alias("n_conversations"), (n_d - n_c).alias("difference"))


def units(spark: SparkSession, sf: str) -> DataFrame:
    """English types with all score parts; age of acquisition stands in as a length rule, opacity by accents."""
    rows = type_stats(spark, sf).where("lang = 'en' AND length(word) >= 3")
    aoa = F.when(F.length("word") <= 12, 2.0 + F.length("word"))
    parts = rows.select(
        "word", "book_count", "dispersion", "zipf",
        S.zipf_need(F.col("zipf")).alias("zipf_need"),
        S.aoa_component(S.aoa_residual(aoa, F.col("zipf"))).alias("aoa_component"),
        F.when(F.length("word") >= 8, 0.7).otherwise(0.5).alias("fr_opacity"),
        S.sense_surprise(F.col("dispersion"), F.col("book_count")).alias("sense_surprise"),
        S.book_gain(F.col("book_count")).alias("book_gain"),
    ).withColumn("reuse", F.col("zipf_need"))
    scored = parts.withColumn("score_comprehension", S.weighted(S.COMPREHENSION)).withColumn("score_reuse", S.weighted(S.REUSE))
    return scored.withColumn("score_default", (F.col("score_comprehension") + F.col("score_reuse")) / 2)


UNITS_SQL = f"""{TYPES_SQL}, p AS (SELECT word, book_count, dispersion, zipf, {NEED_SQL} AS zipf_need,
  CASE WHEN length(word) <= 12 THEN greatest(0, least(1, 0.5 - (2.0 + length(word) - (12 - 1.1 * zipf)) / 8)) ELSE 0.5 END AS aoa_component,
  CASE WHEN length(word) >= 8 THEN 0.7 ELSE 0.5 END AS fr_opacity, 1 - dispersion / book_count AS sense_surprise, {GAIN_SQL} AS book_gain
  FROM types WHERE lang = 'en' AND length(word) >= 3),
q AS (SELECT *, 0.40 * zipf_need + 0.20 * aoa_component + 0.15 * fr_opacity + 0.15 * sense_surprise + 0.10 * book_gain AS sc,
  0.45 * zipf_need + 0.20 * aoa_component + 0.15 * fr_opacity + 0.20 * zipf_need AS sr FROM p),
units AS (SELECT word, book_count, dispersion, zipf, zipf_need, aoa_component, sense_surprise, book_gain, sc AS score_comprehension, sr AS score_reuse, (sc + sr) / 2 AS score_default FROM q)"""


@query(f"""WITH {UNITS_SQL} SELECT word, book_count, dispersion, round(zipf, 6) AS zipf, round(aoa_component, 6) AS aoa_component, round(sense_surprise, 6) AS sense_surprise,
round(score_comprehension, 6) AS score_comprehension, round(score_reuse, 6) AS score_reuse, round(score_default, 6) AS score_default FROM units""")
def q_units_scored(spark: SparkSession, sf: str) -> DataFrame:
    r = [F.round(c, 6).alias(c) for c in ("zipf", "aoa_component", "sense_surprise", "score_comprehension", "score_reuse", "score_default")]
    return units(spark, sf).select("word", "book_count", "dispersion", *r)


def top_ranks(rows: DataFrame, score: str, name: str, n: int = 100) -> DataFrame:
    """The first n by score with their ranks; only they are ranked."""
    top = rows.select("word", F.round(score, 9).alias("s")).orderBy(F.desc("s"), "word").limit(n)
    return top.select("word", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("s"), "word")).alias(name))


RANKS_SQL = f"""{UNITS_SQL}, a AS (SELECT word, row_number() OVER (ORDER BY round(score_comprehension, 9) DESC, word) AS r_comprehension FROM units),
b AS (SELECT word, row_number() OVER (ORDER BY round(score_reuse, 9) DESC, word) AS r_reuse FROM units)"""


@query(f"""WITH {RANKS_SQL} SELECT a.word, r_comprehension, r_reuse, abs(r_comprehension - r_reuse) AS gap FROM a JOIN b ON a.word = b.word
WHERE r_comprehension <= 100 AND r_reuse <= 100 ORDER BY gap DESC, a.word LIMIT 60""")
def q_rank_divergence(spark: SparkSession, sf: str) -> DataFrame:
    rows = units(spark, sf)
    both = top_ranks(rows, "score_comprehension", "r_comprehension").join(top_ranks(rows, "score_reuse", "r_reuse"), "word")
    return both.withColumn("gap", F.abs(F.col("r_comprehension") - F.col("r_reuse"))).orderBy(F.desc("gap"), "word").limit(60)


@query(f"""WITH {UNITS_SQL}, v AS (SELECT word, round(aoa_component, 6) AS v FROM units)
SELECT * FROM (SELECT 'low' AS side, word, v FROM v ORDER BY v, word LIMIT 20) UNION ALL SELECT * FROM (SELECT 'high' AS side, word, v FROM v ORDER BY v DESC, word LIMIT 20)""")
def q_extremes_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = units(spark, sf).select("word", F.round("aoa_component", 6).alias("v"))
    low = rows.orderBy("v", "word").limit(20).select(F.lit("low").alias("side"), "word", "v")
    return low.unionByName(rows.orderBy(F.desc("v"), "word").limit(20).select(F.lit("high").alias("side"), "word", "v"))


@query(f"""WITH {TYPES_SQL} SELECT word, lang, book_count FROM types WHERE contains(word, 'tion')
ORDER BY CASE WHEN word = 'tion' THEN 0 WHEN starts_with(word, 'tion') THEN 1 ELSE 2 END, word, lang LIMIT 30""")
def q_search(spark: SparkSession, sf: str) -> DataFrame:
    rows = tok.types(doc_tokens(spark, sf).where(F.contains("word", F.lit("tion"))), ["word", "lang"], "doc_id")
    hit = F.when(F.col("word") == "tion", 0).when(F.startswith("word", F.lit("tion")), 1).otherwise(2)
    return rows.orderBy(hit, "word", "lang").limit(30).select("word", "lang", "book_count")


@query(f"""WITH {WORDS_SQL}, s AS (SELECT DISTINCT word, source FROM tok) SELECT word, count(*) AS n_sources FROM s GROUP BY word HAVING count(*) >= 5""")
def q_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return doc_tokens(spark, sf).select("word", "source").distinct().groupBy("word").agg(F.count("*").alias("n_sources")).where("n_sources >= 5")


@query("""WITH s AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-zà-ÿ]+')) AS word FROM documents WHERE lang IN ('fr', 'es')),
k AS (SELECT word, regexp_replace(translate(replace(word, 'ß', 'ss'), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '^(.{3,})[sx]$', '\\1') AS stem FROM s)
SELECT stem, count(*) AS n, min(word) AS first_word FROM k GROUP BY stem""".replace("\\\\", "\\"))
def q_accent_fold(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").where("lang IN ('fr', 'es')").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-zà-ÿ]+"), F.lit(0))).alias("word")).distinct()
    return rows.groupBy(T.fr_stem(F.col("word")).alias("stem")).agg(F.count("*").alias("n"), F.min("word").alias("first_word"))


@query(f"""WITH {TYPES_SQL}, r AS (SELECT word, lang, book_count, round((6 - zipf) / 4 + 0.05 * least(book_count, 5), 6) AS priority FROM types),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY priority DESC, word) AS rk FROM r)
SELECT word, lang, priority, CASE WHEN rk <= 200 THEN 'full' ELSE 'fallback' END AS handling FROM k""")
def q_top_k_with_fallback(spark: SparkSession, sf: str) -> DataFrame:
    rows = type_stats(spark, sf).withColumn("priority", F.round(S.coarse_priority(F.col("zipf"), F.col("book_count")), 6))
    top = store.first_of_each(rows.select("lang", "word", "priority"), "lang", [F.desc("priority"), F.col("word")], 200).select("lang", "word", F.lit("full").alias("full"))
    return rows.join(top, ["lang", "word"], "left").select("word", "lang", "priority", F.coalesce("full", F.lit("fallback")).alias("handling"))


@query(f"""WITH {WORDS_SQL}, g AS (SELECT doc_id, word, word || ' ' || lead(word, 1) OVER w AS g2, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w AS g3, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w AS g4 FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
u AS (SELECT doc_id, g2 AS form FROM g WHERE g2 IS NOT NULL UNION ALL SELECT doc_id, g3 FROM g WHERE g3 IS NOT NULL UNION ALL SELECT doc_id, g4 FROM g WHERE g4 IS NOT NULL)
SELECT form, 'mwe' AS unit_type, count(*) AS book_count, count(DISTINCT doc_id) AS dispersion FROM u GROUP BY form HAVING count(*) >= 12
UNION ALL SELECT word, 'word', count(*), count(DISTINCT doc_id) FROM tok GROUP BY word HAVING count(*) >= 12""")
def q_union_words_mwe(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["form", "unit_type", "book_count", "dispersion"]
    mwe = tok.types(frequent_spans(spark, sf), ["label"], "doc_id").withColumnRenamed("label", "form").withColumn("unit_type", F.lit("mwe"))
    single = tok.types(doc_tokens(spark, sf), ["word"], "doc_id").where("book_count >= 12").withColumnRenamed("word", "form").withColumn("unit_type", F.lit("word"))
    return mwe.select(cols).unionByName(single.select(cols))


@query(f"""WITH {WORDS_SQL}, c AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS s FROM documents WHERE lang = 'en'),
n AS (SELECT lower(s) AS word, bool_and(regexp_matches(s, '^[A-Z]')) AS all_named FROM c GROUP BY 1), b AS {words_sql('benchmark')}, v AS {words_sql('conversations')}
SELECT n.word FROM n WHERE all_named AND NOT EXISTS (SELECT 1 FROM v WHERE v.word = n.word) AND NOT EXISTS (SELECT 1 FROM b WHERE b.word = n.word)""")
def q_named_entity_guard(spark: SparkSession, sf: str) -> DataFrame:
    spelled = table(spark, sf, "documents").where("lang = 'en'").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("s")).distinct()
    rows = spelled.groupBy(F.lower("s").alias("word")).agg(F.bool_and(F.col("s").rlike("^[A-Z]")).alias("all_named"))
    known = text_words(spark, sf, "conversations").select("word", F.lit(True).alias("present"))
    marked = rows.join(known, "word", "left").select("word", "all_named", F.col("present").isNull().alias("absent"))
    return select.named_entities(marked, text_words(spark, sf, "benchmark"), "word").select("word")


@query(f"""WITH {TYPES_SQL}, en AS (SELECT word, level FROM types WHERE lang = 'en'),
f AS (SELECT word, unnest(list_distinct(list_filter([word, CASE WHEN word LIKE '%ies' THEN left(word, length(word) - 3) || 'y' END, CASE WHEN word LIKE '%es' THEN left(word, length(word) - 2) END,
  CASE WHEN word LIKE '%s' THEN left(word, length(word) - 1) END, CASE WHEN word LIKE '%ed' THEN left(word, length(word) - 2) END, CASE WHEN word LIKE '%ed' THEN left(word, length(word) - 1) END,
  CASE WHEN word LIKE '%ing' THEN left(word, length(word) - 3) END, CASE WHEN word LIKE '%ing' THEN left(word, length(word) - 3) || 'e' END], lambda x: x IS NOT NULL))) AS form FROM en)
SELECT f.word, count(*) AS n_forms, min(e.level) AS lowest, max(e.level) AS highest, string_agg(DISTINCT e.level, '/' ORDER BY e.level) AS levels FROM f JOIN en e ON e.word = f.form GROUP BY f.word""")
def q_level_lookup(spark: SparkSession, sf: str) -> DataFrame:
    en = type_stats(spark, sf).where("lang = 'en'").select("word", "level")
    forms = en.select("word", F.explode(T.base_forms(F.col("word"))).alias("form"))
    found = forms.join(en.select(F.col("word").alias("form"), "level"), "form")
    return found.groupBy("word").agg(F.count("*").alias("n_forms"), F.min("level").alias("lowest"), F.max("level").alias("highest"), F.array_join(F.array_sort(F.collect_set("level")), "/").alias("levels"))


@query(f"""WITH {TYPES_SQL}, m AS (SELECT word, sum(book_count) AS book_count, string_agg(DISTINCT level, '/' ORDER BY level) AS levels FROM types GROUP BY word)
SELECT levels, count(*) AS n, sum(book_count) AS occurrences FROM m GROUP BY levels""")
def q_level_combinations(spark: SparkSession, sf: str) -> DataFrame:
    merged = type_stats(spark, sf).groupBy("word").agg(F.sum("book_count").alias("book_count"), F.array_join(F.array_sort(F.collect_set("level")), "/").alias("levels"))
    return merged.groupBy("levels").agg(F.count("*").alias("n"), F.sum("book_count").alias("occurrences"))


@query("""WITH s AS (SELECT lower(s) AS lemma, s, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS s FROM documents WHERE lang = 'en') GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY lemma ORDER BY n DESC, s) AS rk FROM s) SELECT lemma, s AS surface, n, rk FROM r WHERE rk <= 6""")
def q_top_surfaces(spark: SparkSession, sf: str) -> DataFrame:
    spelled = table(spark, sf, "documents").where("lang = 'en'").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("surface"))
    counted = spelled.groupBy(F.lower("surface").alias("lemma"), "surface").agg(F.count("*").alias("n"))
    return counted.withColumn("rk", F.row_number().over(W.partitionBy("lemma").orderBy(F.desc("n"), "surface"))).where("rk <= 6")


@query(f"""WITH {TYPES_SQL}, x AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS word FROM documents WHERE lang = 'en'),
j AS (SELECT x.doc_id, x.word, t.zipf FROM x LEFT JOIN types t ON t.word = x.word AND t.lang = 'en')
SELECT doc_id, round(-min(zipf), 6) AS usage_key, bool_and(coalesce(zipf > 3.0, false)) AS attested FROM j GROUP BY doc_id""")
def q_alternatives_by_usage(spark: SparkSession, sf: str) -> DataFrame:
    words = table(spark, sf, "documents").where("lang = 'en'").select("doc_id", F.explode(F.array_distinct(T.words(F.col("text")))).alias("word"))
    freq = type_stats(spark, sf).where("lang = 'en'").select("word", "zipf")
    joined = words.join(freq, "word", "left")
    return joined.groupBy("doc_id").agg(F.round(-F.min("zipf"), 6).alias("usage_key"), F.bool_and(F.coalesce(F.col("zipf") > 3.0, F.lit(False))).alias("attested"))


@query(f"""WITH {TYPES_SQL} SELECT word, lang, round(book_count * 1e6 / sum(book_count) OVER (PARTITION BY lang), 6) AS per_million, round(zipf, 3) AS zipf, round(book_count / dispersion, 6) AS ratio FROM types""")
def q_scale(spark: SparkSession, sf: str) -> DataFrame:
    rows = type_stats(spark, sf)
    totals = rows.groupBy("lang").agg(F.sum("book_count").alias("total"))
    return rows.join(totals, "lang").select("word", "lang", F.round(S.per_million(F.col("book_count"), F.col("total")), 6).alias("per_million"), F.round("zipf", 3).alias("zipf"), F.round(F.col("book_count") / F.col("dispersion"), 6).alias("ratio"))


@query(f"""WITH {WORDS_SQL}, b AS {words_sql('benchmark')} SELECT doc_id, count(*) AS n, count(DISTINCT word) AS n_types FROM tok t WHERE EXISTS (SELECT 1 FROM b WHERE b.word = t.word) GROUP BY doc_id""")
def q_restrict_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    kept = doc_tokens(spark, sf).join(text_words(spark, sf, "benchmark"), "word", "left_semi")
    return kept.groupBy("doc_id", "word").agg(F.count("*").alias("n")).groupBy("doc_id").agg(F.sum("n").alias("n"), F.count("*").alias("n_types"))


@query(f"""WITH {UNITS_SQL}, r AS (SELECT word, book_count, round(score_default, 9) AS s FROM units)
SELECT word, book_count FROM r ORDER BY s DESC, book_count DESC, word LIMIT 100""")
def q_limit_on_order(spark: SparkSession, sf: str) -> DataFrame:
    return units(spark, sf).select("word", "book_count", F.round("score_default", 9).alias("s")).orderBy(F.desc("s"), F.desc("book_count"), "word").limit(100).select("word", "book_count")


@query("""SELECT doc_id, sha256('{"model":"m1","prompt":"' || CAST(doc_id AS VARCHAR) || ':' || lang || '"}') AS key, lang = 'en' AS hit FROM documents""")
def q_cache_key(spark: SparkSession, sf: str) -> DataFrame:
    prompt = F.concat_ws(":", F.col("doc_id").cast("string"), "lang")
    keyed = table(spark, sf, "documents").select("doc_id", "lang", F.sha2(F.to_json(F.struct(F.lit("m1").alias("model"), prompt.alias("prompt"))), 256).alias("key"))
    cache = keyed.where("lang = 'en'").select("key", F.lit(True).alias("c"))
    return keyed.join(cache, "key", "left").select("doc_id", "key", F.coalesce("c", F.lit(False)).alias("hit"))


@query("""SELECT doc_id, lang, CAST(floor((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) / 40) AS BIGINT) AS batch FROM documents""")
def q_batches(spark: SparkSession, sf: str) -> DataFrame:
    return store.batches(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id", 40)


@query(f"""WITH {WORDS_SQL}, {PASSAGES_SQL} SELECT doc_id, '[' || string_agg('{{"start":' || start || ',"end":' || stop || ',"item_id":' || item_id || '}}', ',' ORDER BY start, stop, item_id) || ']' AS spans FROM spans GROUP BY doc_id""")
def q_passage_case_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of each document as one array, written as JSON."""
    return passage_spans(spark, sf).groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("start", "end", "item_id")))).alias("spans"))
