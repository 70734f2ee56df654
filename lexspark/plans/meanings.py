"""Senses: nearest ones, margins, evidence, shares, inventories. Labels of the embeddings stand in for senses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.functions.kernels import french_stem, ratio, token_offsets
from lexspark.operators import senses
from lexspark.plans.corpus import doc_tokens
from lexspark.plans.lexicon import TYPES_SQL, type_stats
from lexspark.plans.registry import WORDS_SQL, query, table


def centroids(spark: SparkSession, sf: str) -> DataFrame:
    """(label, c): the mean vector of each label; one row a label."""
    cells = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("c"))


#: Most means that are held against all vectors at once.
MAX_MEANS = 4_096


def similarities(spark: SparkSession, sf: str) -> DataFrame:
    """(vec_id, own, label, score): cosine of each vector to each label's mean. The means of a block of labels are one broadcast row, of MAX_MEANS at most."""
    means = centroids(spark, sf)
    blocks = -(-means.count() // MAX_MEANS)
    rows = None
    for k in range(max(blocks, 1)):
        own = means if blocks <= 1 else means.where(F.pmod(F.xxhash64("label"), F.lit(blocks)) == k)
        c = own.agg(F.array_sort(F.collect_list(F.struct("label", "c"))).alias("cs"))
        part = table(spark, sf, "embeddings").crossJoin(F.broadcast(c)).select("vec_id", F.col("label").alias("own"), "embedding", F.explode("cs").alias("k"))
        rows = part if rows is None else rows.unionByName(part)
    x = F.transform("embedding", lambda v: v.cast("double"))
    norm = lambda a: F.sqrt(senses.dot(a, a))
    rows = rows.select("vec_id", "own", x.alias("x"), F.col("k.label").alias("label"), F.col("k.c").alias("c"))
    return rows.select("vec_id", "own", "label", F.round(senses.dot(F.col("x"), F.col("c")) / norm(F.col("x")) / norm(F.col("c")), 6).alias("score"))


SIM_SQL = """cell AS (SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings),
m AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS x FROM cell GROUP BY label, i), cen AS (SELECT label, list(x ORDER BY i) AS c FROM m GROUP BY label),
sim AS (SELECT vec_id, e.label AS own, cen.label AS label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c), 6) AS score FROM embeddings e, cen),
rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label DESC) AS r FROM sim),
best AS (SELECT a.vec_id, a.own, a.label AS best, a.score AS best_score, coalesce(a.score - b.score, 1.0) AS margin FROM rk a LEFT JOIN rk b ON a.vec_id = b.vec_id AND b.r = 2 WHERE a.r = 1)"""


def nearest(spark: SparkSession, sf: str) -> DataFrame:
    return senses.best_and_margin(similarities(spark, sf), ["vec_id", "own"], "label", "score")


@query(f"WITH {SIM_SQL} SELECT vec_id, best, best_score, round(margin, 6) AS margin, best_score >= 0.45 AS accepted FROM best")
def q_nearest_sense(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(spark, sf).select("vec_id", "best", "best_score", F.round("margin", 6).alias("margin"), (F.col("best_score") >= 0.45).alias("accepted"))


@query(f"WITH {SIM_SQL} SELECT s.vec_id, 1 + count(*) FILTER (WHERE s.score > o.score) AS rank FROM sim s JOIN sim o ON s.vec_id = o.vec_id AND o.label = o.own GROUP BY s.vec_id")
def q_discrimination_rank(spark: SparkSession, sf: str) -> DataFrame:
    ranked = similarities(spark, sf).withColumn("rank", F.rank().over(W.partitionBy("vec_id").orderBy(F.desc("score"))))
    return ranked.where("label = own").select("vec_id", F.col("rank").cast("long").alias("rank"))


@query(f"""WITH {SIM_SQL} SELECT vec_id, round(margin, 6) < 0.15 OR best_score <= 0 OR best <> own AS arbitrate,
CASE WHEN best_score <= 0 THEN 'all_zero' WHEN best <> own THEN 'disagreement' WHEN round(margin, 6) < 0.15 THEN 'margin' ELSE 'none' END AS why FROM best""")
def q_arbitration_flags(spark: SparkSession, sf: str) -> DataFrame:
    zero, differ, margin = F.col("best_score") <= 0, F.col("best") != F.col("own"), F.round("margin", 6)
    why = F.when(zero, "all_zero").when(differ, "disagreement").when(margin < 0.15, "margin").otherwise("none")
    return nearest(spark, sf).select("vec_id", senses.needs_arbitration(margin, zero, differ).alias("arbitrate"), why.alias("why"))


COUNTS_SQL = "c AS (SELECT l.quality, e.label, count(*) AS n FROM embeddings e JOIN labels l ON l.doc_id = e.vec_id GROUP BY 1, 2)"


def sense_counts(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("vec_id"), "quality")
    return table(spark, sf, "embeddings").join(labels, "vec_id").groupBy("quality", "label").agg(F.count("*").alias("n"))


@query(f"""WITH {COUNTS_SQL} SELECT quality, label, n, round(n / sum(n) OVER (PARTITION BY quality), 6) AS share,
round(sum(n) OVER (PARTITION BY quality ORDER BY n DESC, label ROWS UNBOUNDED PRECEDING) / sum(n) OVER (PARTITION BY quality), 6) AS cumulative FROM c""")
def q_sense_shares(spark: SparkSession, sf: str) -> DataFrame:
    rows = senses.cumulative_share(sense_counts(spark, sf), ["quality"], "n", "label")
    return rows.withColumn("share", F.round("share", 6)).withColumn("cumulative", F.round("cumulative", 6))


@query(f"WITH {COUNTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY n DESC, label) AS k FROM c) SELECT quality, label, n FROM r WHERE k = 1")
def q_dominant_sense(spark: SparkSession, sf: str) -> DataFrame:
    return senses.dominant(sense_counts(spark, sf), ["quality"], "label", "n")


@query(f"""WITH {WORDS_SQL}, b AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS word FROM benchmark),
h AS (SELECT DISTINCT t.doc_id, b.item_id, t.word FROM (SELECT DISTINCT doc_id, word FROM tok) t JOIN b ON b.word = t.word),
v AS (SELECT *, 1.0 / count(*) OVER (PARTITION BY doc_id, word) * CASE WHEN word LIKE 'th%' THEN 0.15 ELSE 1.0 END AS worth FROM h)
SELECT doc_id, item_id AS candidate, round(max(worth), 6) AS fr_score FROM v GROUP BY doc_id, item_id""")
def q_candidate_evidence(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("candidate"), F.explode(F.array_distinct(T.words(F.col("text")))).alias("hit_key"))
    found = doc_tokens(spark, sf).select("doc_id", F.col("word").alias("hit_key")).distinct()
    hits = found.join(items, "hit_key").withColumn("claimed", F.col("hit_key").startswith("th"))
    return senses.evidence(hits, ["doc_id"]).withColumn("fr_score", F.round("fr_score", 6))


@query(f"""WITH {SIM_SQL} SELECT b.vec_id, b.best FROM best b JOIN labels l ON l.doc_id = b.vec_id
WHERE b.best_score >= 0.25 AND l.quality = 1 AND EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = b.vec_id AND e.label = b.best)""")
def q_confident_best(spark: SparkSession, sf: str) -> DataFrame:
    good = nearest(spark, sf).where("best_score >= 0.25")
    candidates = table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("best"))
    labelled = table(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").alias("vec_id"))
    return good.join(candidates, ["vec_id", "best"], "left_semi").join(labelled, "vec_id", "left_semi").select("vec_id", "best")


@query("""WITH b AS (SELECT 'omw-en-' || lpad(CAST(item_id AS VARCHAR), 8, '0') || '-n' AS id, length(text) AS n FROM benchmark),
e AS (SELECT 'eng-30-' || lpad(CAST(vec_id AS VARCHAR), 8, '0') || '-n' AS key, label FROM embeddings)
SELECT b.id, e.key, e.label, b.n FROM b LEFT JOIN e ON e.key = replace(b.id, 'omw-en-', 'eng-30-')""")
def q_dictionary_join(spark: SparkSession, sf: str) -> DataFrame:
    eight = lambda c: F.lpad(F.col(c).cast("string"), 8, "0")
    items = table(spark, sf, "benchmark").select(F.concat(F.lit("omw-en-"), eight("item_id"), F.lit("-n")).alias("id"), F.length("text").cast("long").alias("n"))
    entries = table(spark, sf, "embeddings").select(F.concat(F.lit("eng-30-"), eight("vec_id"), F.lit("-n")).alias("key"), "label")
    return items.join(entries, T.dictionary_id(F.col("id")) == F.col("key"), "left").select("id", "key", "label", "n")


@query("""SELECT a.doc_id, a.lang, count(*) AS n_inventory, count(*) FILTER (WHERE b.source = a.source) AS n_exact, max(CASE WHEN b.doc_id = a.doc_id THEN 1 ELSE 0 END) AS has_current
FROM documents a JOIN documents b ON a.lang = b.lang AND a.n_chars = b.n_chars GROUP BY a.doc_id, a.lang""")
def q_inventory_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of the group and of its exact part, joined back: no pairs are made."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    exact = docs.groupBy("lang", "n_chars", "source").agg(F.count("*").alias("n_exact"))
    whole = exact.groupBy("lang", "n_chars").agg(F.sum("n_exact").alias("n_inventory"))
    joined = docs.join(exact, ["lang", "n_chars", "source"]).join(whole, ["lang", "n_chars"])
    return joined.select("doc_id", "lang", "n_inventory", "n_exact", F.lit(1).alias("has_current"))


@query(f"""WITH {WORDS_SQL}, b AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS word FROM benchmark),
h AS (SELECT DISTINCT t.doc_id, b.item_id, t.word FROM (SELECT DISTINCT doc_id, word FROM tok) t JOIN b ON b.word = t.word),
v AS (SELECT *, 1.0 / count(*) OVER (PARTITION BY doc_id, word) * CASE WHEN word LIKE 'th%' THEN 0.15 ELSE 1.0 END AS worth FROM h)
SELECT doc_id, item_id AS candidate, round(max(worth), 6) AS fr_score FROM v GROUP BY doc_id, item_id""")
def q_candidate_evidence(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("candidate"), F.explode(F.array_distinct(T.words(F.col("text")))).alias("hit_key"))
    found = doc_tokens(spark, sf).select("doc_id", F.col("word").alias("hit_key")).distinct()
    hits = found.join(items, "hit_key").withColumn("claimed", F.col("hit_key").startswith("th"))
    return senses.evidence(hits, ["doc_id"]).withColumn("fr_score", F.round("fr_score", 6))


@query(f"""WITH {SIM_SQL} SELECT b.vec_id, b.best FROM best b JOIN labels l ON l.doc_id = b.vec_id
WHERE b.best_score >= 0.25 AND l.quality = 1 AND EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = b.vec_id AND e.label = b.best)""")
def q_confident_best(spark: SparkSession, sf: str) -> DataFrame:
    good = nearest(spark, sf).where("best_score >= 0.25")
    candidates = table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("best"))
    labelled = table(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").alias("vec_id"))
    return good.join(candidates, ["vec_id", "best"], "left_semi").join(labelled, "vec_id", "left_semi").select("vec_id", "best")


@query("""WITH b AS (SELECT 'omw-en-' || lpad(CAST(item_id AS VARCHAR), 8, '0') || '-n' AS id, length(text) AS n FROM benchmark),
e AS (SELECT 'eng-30-' || lpad(CAST(vec_id AS VARCHAR), 8, '0') || '-n' AS key, label FROM embeddings)
SELECT b.id, e.key, e.label, b.n FROM b LEFT JOIN e ON e.key = replace(b.id, 'omw-en-', 'eng-30-')""")
def q_dictionary_join(spark: SparkSession, sf: str) -> DataFrame:
    eight = lambda c: F.lpad(F.col(c).cast("string"), 8, "0")
    items = table(spark, sf, "benchmark").select(F.concat(F.lit("omw-en-"), eight("item_id"), F.lit("-n")).alias("id"), F.length("text").cast("long").alias("n"))
    entries = table(spark, sf, "embeddings").select(F.concat(F.lit("eng-30-"), eight("vec_id"), F.lit("-n")).alias("key"), "label")
    return items.join(entries, T.dictionary_id(F.col("id")) == F.col("key"), "left").select("id", "key", "label", "n")


@query("""SELECT a.doc_id, a.lang, count(*) AS n_inventory, count(*) FILTER (WHERE b.source = a.source) AS n_exact, max(CASE WHEN b.doc_id = a.doc_id THEN 1 ELSE 0 END) AS has_current
FROM documents a JOIN documents b ON a.lang = b.lang AND a.n_chars = b.n_chars GROUP BY a.doc_id, a.lang""")
def q_inventory_flags(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    other = docs.select(F.col("doc_id").alias("o"), "lang", F.col("source").alias("o_source"), "n_chars")
    joined = docs.join(other, ["lang", "n_chars"])
    current = F.max(F.when(F.col("o") == F.col("doc_id"), 1).otherwise(0))
    return joined.groupBy("doc_id", "lang").agg(F.count("*").alias("n_inventory"), F.count_if(F.col("o_source") == F.col("source")).alias("n_exact"), current.alias("has_current"))


@query(f"""WITH {WORDS_SQL}, b AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS word FROM benchmark),
d AS (SELECT DISTINCT doc_id, word FROM tok), o AS (SELECT b.item_id, d.doc_id, count(*) AS overlap FROM b JOIN d ON b.word = d.word GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY overlap DESC, doc_id) AS k FROM o WHERE overlap >= 2) SELECT item_id, doc_id, overlap FROM r WHERE k = 1""")
def q_best_overlap_segment(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark").select("item_id", F.explode(F.array_distinct(T.words(F.col("text")))).alias("word"))
    docs = doc_tokens(spark, sf).select("doc_id", "word").distinct()
    overlap = items.join(docs, "word").groupBy("item_id", "doc_id").agg(F.count("*").alias("overlap")).where("overlap >= 2")
    best = overlap.groupBy("item_id").agg(F.min(F.struct((-F.col("overlap")).alias("n"), "doc_id")).alias("b"))
    return best.select("item_id", "b.doc_id", (-F.col("b.n")).alias("overlap"))


@query("""WITH w AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS word FROM benchmark), n AS (SELECT item_id, count(*) AS n FROM w GROUP BY item_id),
s AS (SELECT x.item_id AS a, y.item_id AS b, count(*) AS shared FROM w x JOIN w y ON x.word = y.word AND x.item_id < y.item_id GROUP BY 1, 2)
SELECT a, b, shared, round(shared / (na.n + nb.n - shared), 6) AS jaccard FROM s JOIN n na ON na.item_id = a JOIN n nb ON nb.item_id = b""")
def q_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of items with a shared word, found through the words; the similarity follows from counts."""
    words = table(spark, sf, "benchmark").select("item_id", F.explode(F.array_distinct(T.words(F.col("text")))).alias("word"))
    n = words.groupBy("item_id").agg(F.count("*").alias("n"))
    other = words.select(F.col("item_id").alias("b"), "word")
    shared = words.select(F.col("item_id").alias("a"), "word").join(other, "word").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    sized = shared.join(n.select(F.col("item_id").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("item_id").alias("b"), F.col("n").alias("nb")), "b")
    return sized.select("a", "b", "shared", F.round(F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared")), 6).alias("jaccard"))


@query(f"""WITH {TYPES_SQL}, r AS (SELECT t.word, t.lang, d.doc_id FROM types t JOIN (SELECT DISTINCT doc_id, lang, word FROM tok) d ON d.word = t.word AND d.lang = t.lang),
n AS (SELECT *, row_number() OVER (PARTITION BY word, lang ORDER BY doc_id) - 1 AS k, count(*) OVER (PARTITION BY word, lang) AS n FROM r)
SELECT word, lang, string_agg(CAST(doc_id AS VARCHAR), ' || ' ORDER BY doc_id) AS examples FROM n WHERE k = 0 OR k = CAST(floor(n / 2) AS BIGINT) GROUP BY word, lang""")
def q_occurrence_index(spark: SparkSession, sf: str) -> DataFrame:
    seen = doc_tokens(spark, sf).select("doc_id", "lang", "word").distinct()
    two = senses.diverse(seen, ["word", "lang"], ["doc_id"], 2)
    return two.groupBy("word", "lang").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), " || ").alias("examples"))


@query("""WITH s AS (SELECT conv_id, turn, list_distinct(list_transform(list_filter(regexp_split_to_array(replace(lower(text), 'ß', 'ss'), '[^a-zà-ÿ]+'), lambda x: length(x) > 2),
  lambda x: regexp_replace(translate(x, 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '^(.{3,})[sx]$', '\\1'))) AS stems FROM conversations)
SELECT conv_id, turn, len(stems) AS n_stems, CASE WHEN list_contains(stems, 'eau') THEN 'eau' ELSE 'none' END AS key FROM s""".replace("\\\\", "\\"))
def q_claimed_evidence(spark: SparkSession, sf: str) -> DataFrame:
    stems = table(spark, sf, "conversations").select("conv_id", "turn", T.stems_of(F.col("text")).alias("stems"), T.normalize_phrase(F.col("text")).alias("n"))
    key = F.coalesce(T.match_key(F.lit("eaux"), F.col("stems"), F.col("n")), F.lit("none"))
    return stems.select("conv_id", "turn", F.size("stems").cast("long").alias("n_stems"), key.alias("key"))


@query("""WITH k AS (SELECT label, 's' || (vec_id % 7) AS sense_key, count(*) AS n FROM embeddings GROUP BY 1, 2), r AS (SELECT 's' || x AS sense_key, x AS synset FROM (SELECT unnest(range(5)) AS x))
SELECT k.label, sum(k.n) AS n_all, coalesce(sum(k.n) FILTER (WHERE r.synset IS NOT NULL), 0) AS n_resolved, count(*) FILTER (WHERE r.synset IS NULL) AS n_unresolved_keys FROM k LEFT JOIN r ON k.sense_key = r.sense_key GROUP BY k.label""")
def q_sense_count_views(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "embeddings").groupBy("label", F.concat(F.lit("s"), (F.col("vec_id") % 7).cast("string")).alias("sense_key")).agg(F.count("*").alias("n"))
    resolved = spark.range(5).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("sense_key"), F.col("id").alias("synset"))
    joined = keys.join(F.broadcast(resolved), "sense_key", "left")  # five rows
    hit = F.col("synset").isNotNull()
    return joined.groupBy("label").agg(F.sum("n").alias("n_all"), F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_resolved"), F.count_if(~hit).alias("n_unresolved_keys"))


@query(r"""WITH b AS (SELECT item_id, text FROM benchmark), f AS (SELECT item_id, text, replace(lower(text), 'ß', 'ss') AS folded FROM b)
SELECT item_id, folded, translate(folded, 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy') AS bare,
  trim(regexp_replace(regexp_replace(regexp_replace(translate(folded, 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '-', ' ', 'g'), '[^a-z0-9'' ]', ' ', 'g'), ' +', ' ', 'g')) AS phrase,
  array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(folded, '[a-z'']+'), lambda w: length(w) > 2))), ' ') AS content,
  regexp_matches(folded, '(ing|ed|ies|es|s)$') AS inflected,
  trim(regexp_replace(trim(folded), '^(to|the|a|an)\s+', ''), ' .,;:!?"''') AS back_key FROM f""")
def q_text_normalise(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("text")
    return table(spark, sf, "benchmark").select(
        "item_id", T.fold(c).alias("folded"), T.strip_accents(T.fold(c)).alias("bare"), T.normalize_phrase(c).alias("phrase"),
        F.array_join(F.array_sort(T.content_words(c)), " ").alias("content"), T.looks_inflected(T.fold(c)).alias("inflected"), T.back_translation_key(c).alias("back_key"),
    )


@query()
def q_ratio_opacity(spark: SparkSession, sf: str) -> DataFrame:
    """Similarity of each benchmark item to the next one, by matching blocks over the whole texts."""
    rows = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("a"))
    following = rows.select((F.col("item_id") - 1).alias("item_id"), F.col("a").alias("b"))
    return rows.join(following, "item_id").select("item_id", F.round(1 - ratio(F.col("a"), F.col("b")), 6).alias("opacity"))


@query()
def q_french_stem(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "documents").where("lang = 'fr'").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-zà-ÿ]+"), F.lit(0))).alias("word")).distinct()
    return found.groupBy(french_stem(F.col("word")).alias("stem")).agg(F.count("*").alias("n"), F.min("word").alias("first_word"))


@query()
def q_token_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.posexplode(token_offsets(F.col("text"))).alias("pos", "t")).select("doc_id", "pos", "t.surface", "t.start", "t.end")
