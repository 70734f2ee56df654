"""Segments, tokens, types and expressions over the documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexspark.functions import scores as S
from lexspark.functions import text as T
from lexspark.operators import segment as seg
from lexspark.operators import grams, senses, spans
from lexspark.operators import tokens as tok
from lexspark.plans.registry import FRONT_SQL, KIND_SQL, LINES_SQL, NAME_SQL, NWORDS_SQL, WORDS_SQL, query, table


def doc_lines(spark: SparkSession, sf: str) -> DataFrame:
    return seg.lines(table(spark, sf, "documents"), "doc_id", "text", "lang")


def doc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return tok.tokens(table(spark, sf, "documents"), "doc_id", "text", "lang", "source")


@query(f"""WITH {LINES_SQL}, kept AS (SELECT * FROM lines WHERE NOT {NAME_SQL})
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS idx, {KIND_SQL} AS kind, {NWORDS_SQL} AS n_words FROM kept""")
def q_segments(spark: SparkSession, sf: str) -> DataFrame:
    rows = seg.speakers(doc_lines(spark, sf), "doc_id")
    return seg.numbered(rows, "doc_id").select("doc_id", "idx", seg.line_kind(F.col("line")).alias("kind"), seg.n_words(F.col("line")).alias("n_words"))


@query(f"WITH {LINES_SQL} SELECT {KIND_SQL} AS kind, count(*) AS n FROM lines GROUP BY 1")
def q_kind_counts(spark: SparkSession, sf: str) -> DataFrame:
    return doc_lines(spark, sf).groupBy(seg.line_kind(F.col("line")).alias("kind")).agg(F.count("*").alias("n"))


@query(f"""WITH {LINES_SQL}, s AS (
  SELECT doc_id, line_no, {NAME_SQL} AS named,
    last_value(CASE WHEN {NAME_SQL} THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS speaker FROM lines)
SELECT doc_id, line_no, speaker FROM s WHERE NOT named AND speaker IS NOT NULL""")
def q_speaker_ffill(spark: SparkSession, sf: str) -> DataFrame:
    return seg.speakers(doc_lines(spark, sf), "doc_id").where("speaker IS NOT NULL").select("doc_id", "line_no", "speaker")


@query(f"""WITH {LINES_SQL}, f AS (
  SELECT doc_id, line_no, {NWORDS_SQL} AS n, min(CASE WHEN {NWORDS_SQL} >= 4 AND NOT {FRONT_SQL} THEN line_no END) OVER (PARTITION BY doc_id) AS first_line FROM lines)
SELECT doc_id, count(*) AS n_lines, min(line_no) AS first_kept FROM f WHERE n >= 4 OR line_no > first_line GROUP BY doc_id""")
def q_front_matter_latch(spark: SparkSession, sf: str) -> DataFrame:
    return seg.after_front_matter(doc_lines(spark, sf), "doc_id").groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.min("line_no").alias("first_kept"))


@query(f"""WITH {LINES_SQL} SELECT doc_id, line_no, CASE WHEN line_no BETWEEN 2 AND 3 OR line_no BETWEEN 7 AND 9 THEN 'hors_oeuvre' ELSE {KIND_SQL} END AS kind
FROM lines WHERE line_no BETWEEN 2 AND 3 OR line_no BETWEEN 7 AND 9 OR NOT {NAME_SQL}""")
def q_excluded_ranges(spark: SparkSession, sf: str) -> DataFrame:
    ranges = [(2, 3), (7, 9)]
    rows = seg.speakers(doc_lines(spark, sf), "doc_id", ranges)
    kind = F.when(seg.in_ranges(F.col("line_no"), ranges), "hors_oeuvre").otherwise(seg.line_kind(F.col("line")))
    return rows.select("doc_id", "line_no", kind.alias("kind"))


def turn_pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").where("role <> 'system'")
    before = F.lag("role").over(W.partitionBy("conv_id").orderBy("turn"))
    marked = rows.withColumn("starts", before.isNull() | (before != F.col("role")))
    return seg.block_pairs(marked, "conv_id", "turn", F.col("starts"), "text")


PAIRS_SQL = """r AS (SELECT conv_id, turn, role, text, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS was FROM conversations WHERE role <> 'system'),
g AS (SELECT *, sum(CASE WHEN was IS NULL OR was <> role THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS run FROM r),
j AS (SELECT conv_id, run, string_agg(text, ' ' ORDER BY turn) AS t FROM g GROUP BY conv_id, run),
pairs AS (SELECT conv_id, CAST(floor(run / 2) AS BIGINT) AS pair, max(CASE WHEN run % 2 = 0 THEN t END) AS en, max(CASE WHEN run % 2 = 1 THEN t END) AS fr FROM j GROUP BY 1, 2 HAVING fr IS NOT NULL)"""


@query(f"WITH {PAIRS_SQL} SELECT * FROM pairs")
def q_block_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return turn_pairs(spark, sf)


MARKERS_SQL = seg.FRENCH_MARKERS.replace("'", "''")


@query(f"""WITH {PAIRS_SQL}, c AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE trim(fr) = '') AS n_empty, count(*) - count(DISTINCT fr) AS n_duplicate,
    count(*) FILTER (WHERE NOT regexp_matches(fr, '{MARKERS_SQL}', 'i') AND regexp_matches(en, '{MARKERS_SQL}', 'i')) AS n_swapped,
    count(*) FILTER (WHERE trim(en) <> '' AND trim(fr) <> '' AND (length(fr) / greatest(1, length(en)) < 0.3 OR length(fr) / greatest(1, length(en)) > 3.0)) AS n_odd FROM pairs)
SELECT *, n > 0 AND n_empty <= 0.05 * n AND n_swapped <= 0.05 * n AND n_odd <= 0.10 * n AS passes FROM c""")
def q_alignment_quality(spark: SparkSession, sf: str) -> DataFrame:
    return seg.alignment_quality(turn_pairs(spark, sf))


@query(f"WITH {WORDS_SQL} SELECT doc_id, pos, word FROM tok")
def q_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return doc_tokens(spark, sf).select("doc_id", "pos", "word")


@query(f"WITH {WORDS_SQL} SELECT word, lang, count(*) AS book_count, count(DISTINCT doc_id) AS dispersion FROM tok GROUP BY word, lang")
def q_types(spark: SparkSession, sf: str) -> DataFrame:
    return tok.types(doc_tokens(spark, sf), ["word", "lang"], "doc_id")


@query("""WITH s AS (SELECT DISTINCT lang, unnest(regexp_extract_all(text, '[A-Za-z]+(?:''[A-Za-z]+)?')) AS surface FROM documents)
SELECT lang, lower(surface) AS lemma, string_agg(surface, '/' ORDER BY surface) AS surface_forms FROM s GROUP BY 1, 2""")
def q_surface_forms(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("lang", F.explode(T.apostrophe_words(F.col("text"))).alias("surface"))
    joined = tok.surfaces(rows.withColumn("lemma", F.lower("surface")), ["lang", "lemma"], "surface")
    return joined.withColumn("surface_forms", F.array_join("surface_forms", "/"))


STOP_SQL = ", ".join(f"'{w}'" for w in tok.STOP)


@query(f"WITH {WORDS_SQL} SELECT lang, count(*) AS n, count(DISTINCT word) AS n_types FROM tok WHERE length(word) >= 3 AND word NOT IN ({STOP_SQL}) GROUP BY lang")
def q_content_filter(spark: SparkSession, sf: str) -> DataFrame:
    per_type = tok.content_only(doc_tokens(spark, sf)).groupBy("lang", "word").agg(F.count("*").alias("n"))
    return per_type.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("n_types"))


@query(f"WITH {WORDS_SQL} SELECT lang, word, min(doc_id) AS doc_id, arg_min(pos, doc_id * 1000000 + pos) AS pos FROM tok GROUP BY lang, word")
def q_first_occurrence(spark: SparkSession, sf: str) -> DataFrame:
    return tok.first_occurrence(doc_tokens(spark, sf).select("lang", "word", "doc_id", "pos"), ["lang", "word"], "doc_id", "pos")


GRAMS_SQL = """g3 AS (SELECT doc_id, pos, word || ' ' || w1 || ' ' || w2 AS gram FROM (
  SELECT doc_id, pos, word, lead(word, 1) OVER (PARTITION BY doc_id ORDER BY pos) AS w1, lead(word, 2) OVER (PARTITION BY doc_id ORDER BY pos) AS w2 FROM tok) WHERE w2 IS NOT NULL)"""


def doc_grams(spark: SparkSession, sf: str, n: int) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", T.words(F.col("text")).alias("w"))
    return tok.array_grams(docs, "w", n, "doc_id", "lang")


@query(f"""WITH {WORDS_SQL}, {GRAMS_SQL}
SELECT gram, count(*) AS book_count, count(DISTINCT doc_id) AS dispersion, round(count(*) * 1e6 / (SELECT count(*) FROM tok), 6) AS per_million
FROM g3 GROUP BY gram HAVING count(*) >= 5""")
def q_ngram_frequency(spark: SparkSession, sf: str) -> DataFrame:
    grams = doc_grams(spark, sf, 3)
    total = table(spark, sf, "documents").agg(F.sum(F.size(T.words(F.col("text")))).alias("n"))  # one row, from a scan without shuffle
    found = tok.corpus_frequency(grams, "doc_id", total).where("book_count >= 5")
    return found.withColumn("per_million", F.round("per_million", 6))


@query(f"""WITH {WORDS_SQL}, {GRAMS_SQL}, often AS (SELECT gram FROM g3 GROUP BY gram HAVING count(*) >= 8),
r AS (SELECT gram, doc_id, pos, row_number() OVER (PARTITION BY gram ORDER BY doc_id, pos) AS example FROM g3 WHERE gram IN (SELECT gram FROM often))
SELECT * FROM r WHERE example <= 3""")
def q_ngram_examples(spark: SparkSession, sf: str) -> DataFrame:
    grams = doc_grams(spark, sf, 3).select("gram", "doc_id", "pos")
    often = grams.groupBy("gram").agg(F.count("*").alias("n")).where("n >= 8").select("gram")
    ranked = grams.join(often, "gram", "left_semi").withColumn("example", F.row_number().over(W.partitionBy("gram").orderBy("doc_id", "pos")))
    return ranked.where("example <= 3")


@query(f"""WITH {WORDS_SQL} SELECT a.doc_id, a.pos AS start, b.pos AS "end" FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND a.word = 'the' AND b.word = 'and'
WHERE b.pos > a.pos AND b.pos - a.pos - 1 <= 2""")
def q_slop_match(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", T.words(F.col("text")).alias("w"))
    return tok.gapped(docs, "doc_id", "w", "the", "and", 2)


#: Words by which passages are looked up.
KEY_WORDS = 5


def passage_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Places of benchmark passages in documents: passages are looked up by their first words, KEY_WORDS or all they have, then compared whole."""
    items = table(spark, sf, "benchmark").select("item_id", T.words(F.col("text")).alias("w")).where("size(w) > 0")
    items = items.select("item_id", "w", F.array_join(F.slice("w", 1, KEY_WORDS), " ").alias("gram"))
    known = items.select("gram").distinct()
    docs = table(spark, sf, "documents").select("doc_id", T.words(F.col("text")).alias("dw"))
    places = None
    for n in range(1, KEY_WORDS + 1):  # places of words that no passage begins with go before the texts are joined
        own = tok.array_grams(docs, "dw", n, "doc_id").join(known.where(F.size(F.split("gram", " ")) == n), "gram", "left_semi")
        places = own if places is None else places.unionByName(own)
    hits = places.join(items, "gram").join(docs, "doc_id")
    whole = F.slice("dw", F.col("pos") + 1, F.size("w")) == F.col("w")
    return hits.where(whole).select("doc_id", "item_id", F.col("pos").alias("start"), (F.col("pos") + F.size("w")).alias("end"))


PASSAGES_SQL = """items AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z]+') AS iw FROM benchmark),
dpos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docw),
spans AS (SELECT d.doc_id, b.item_id, d.i - 1 AS start, d.i - 1 + len(b.iw) AS stop
  FROM dpos d JOIN items b ON d.w[d.i] = b.iw[1] AND len(d.w) >= d.i + len(b.iw) - 1
  WHERE array_to_string(d.w[d.i:d.i + len(b.iw) - 1], ' ') = array_to_string(b.iw, ' '))"""


@query(f'WITH {WORDS_SQL}, {PASSAGES_SQL} SELECT doc_id, item_id, start, stop AS "end" FROM spans')
def q_passage_spans(spark: SparkSession, sf: str) -> DataFrame:
    return passage_spans(spark, sf)


@query(f"""WITH {WORDS_SQL}, {PASSAGES_SQL} SELECT doc_id, count(*) AS n, min(pos) AS first_pos FROM tok t
WHERE NOT EXISTS (SELECT 1 FROM spans s WHERE s.doc_id = t.doc_id AND s.start <= t.pos AND t.pos < s.stop) GROUP BY doc_id""")
def q_covered_tokens(spark: SparkSession, sf: str) -> DataFrame:
    left = spans.uncovered(doc_tokens(spark, sf), passage_spans(spark, sf), "doc_id")
    return left.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))


def frequent_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Places of 2- to 4-grams that documents share."""
    grams = None
    for n in (2, 3, 4):
        own = doc_grams(spark, sf, n).select("doc_id", F.col("pos").alias("start"), (F.col("pos") + n).alias("end"), F.col("gram").alias("label"))
        grams = own if grams is None else grams.unionByName(own)
    often = grams.groupBy("label").agg(F.count("*").alias("n")).where("n >= 12").select("label")
    return grams.join(often, "label", "left_semi").select("doc_id", "start", "end", "label")


FREQUENT_SQL = f"""WITH {WORDS_SQL}, ld AS (SELECT doc_id, pos, word, lead(word, 1) OVER w AS w1, lead(word, 2) OVER w AS w2, lead(word, 3) OVER w AS w3 FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
g AS (SELECT doc_id, pos AS start, pos + 2 AS stop, word || ' ' || w1 AS label FROM ld WHERE w1 IS NOT NULL UNION ALL SELECT doc_id, pos, pos + 3, word || ' ' || w1 || ' ' || w2 FROM ld WHERE w2 IS NOT NULL
  UNION ALL SELECT doc_id, pos, pos + 4, word || ' ' || w1 || ' ' || w2 || ' ' || w3 FROM ld WHERE w3 IS NOT NULL),
f AS (SELECT * FROM g WHERE label IN (SELECT label FROM g GROUP BY label HAVING count(*) >= 12))"""


@query(FREQUENT_SQL + """, c AS (SELECT doc_id, list({'k': start - stop, 's': start, 'e': stop, 'l': label} ORDER BY start - stop, start, stop, label) AS xs FROM (SELECT DISTINCT * FROM f) GROUP BY doc_id),
kept AS (SELECT doc_id, list_reduce(list_transform(xs, lambda x: [x]), lambda a, b: CASE WHEN len(list_filter(a, lambda y: y.s < b[1].e AND b[1].s < y.e)) > 0 THEN a ELSE list_concat(a, b) END) AS k FROM c)
SELECT doc_id, x.s AS start, x.e AS "end", x.l AS label FROM (SELECT doc_id, unnest(k) AS x FROM kept)""")
def q_greedy_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Places of 2- to 4-grams that documents share, without overlap."""
    return grams.greedy_frequent_spans(table(spark, sf, "documents"), "doc_id", "text")


@query(f"""WITH {WORDS_SQL}, {PASSAGES_SQL} SELECT item_id, count(*) AS book_count, count(DISTINCT doc_id) AS dispersion, min(doc_id) AS first_seen FROM spans GROUP BY item_id""")
def q_mwe_units(spark: SparkSession, sf: str) -> DataFrame:
    return spans.expression_units(passage_spans(spark, sf), "item_id", "doc_id", "doc_id")


@query("""WITH w AS (SELECT conv_id, turn, text,
  string_agg(text, ' ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS context,
  coalesce(sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), 0) AS start FROM conversations)
SELECT conv_id, turn, context, CAST(start AS BIGINT) AS start, CAST(start + length(text) AS BIGINT) AS "end" FROM w""")
def q_context_window(spark: SparkSession, sf: str) -> DataFrame:
    return senses.context(table(spark, sf, "conversations"), "conv_id", "turn", "text").select("conv_id", "turn", "context", "start", "end")


@query(f"""WITH {WORDS_SQL}, o AS (SELECT DISTINCT word, doc_id FROM tok),
n AS (SELECT word, doc_id, row_number() OVER (PARTITION BY word ORDER BY doc_id) - 1 AS k, count(*) OVER (PARTITION BY word) AS n FROM o)
SELECT word, doc_id FROM n WHERE k = 0 OR k = CAST(floor(n / 2) AS BIGINT)""")
def q_diverse_occurrences(spark: SparkSession, sf: str) -> DataFrame:
    rows = doc_tokens(spark, sf).select("word", "doc_id").distinct()
    return senses.diverse(rows, ["word"], ["doc_id"], 2)


@query(f"""WITH {WORDS_SQL}, t AS (SELECT word, count(*) AS book_count, count(DISTINCT doc_id) AS dispersion FROM tok WHERE lang = 'en' GROUP BY word),
z AS (SELECT *, log10(book_count / (SELECT sum(book_count) FROM t) * 1e9) AS zipf FROM t WHERE length(word) >= 3),
u AS (SELECT *, greatest(0, least(1, (6 - zipf) / 4)) AS zipf_need, greatest(0, least(1, ln(1 + book_count) / ln(21))) AS book_gain FROM z)
SELECT word, book_count, dispersion, round(zipf, 6) AS zipf, round(0.6 * zipf_need + 0.4 * book_gain, 6) AS score FROM u ORDER BY score DESC, word LIMIT 50""")
def q_top_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: words of the English documents by need and gain."""
    per_type = tok.types(doc_tokens(spark, sf).where("lang = 'en'"), ["word"], "doc_id")
    total = per_type.agg(F.sum("book_count").alias("total"))
    rows = per_type.crossJoin(F.broadcast(total)).where(F.length("word") >= 3).withColumn("zipf", S.zipf(F.col("book_count"), F.col("total")))
    score = 0.6 * S.zipf_need(F.col("zipf")) + 0.4 * S.book_gain(F.col("book_count"))
    return rows.select("word", "book_count", "dispersion", F.round("zipf", 6).alias("zipf"), F.round(score, 6).alias("score")).orderBy(F.desc("score"), "word").limit(50)


@query("""WITH p AS (SELECT conv_id, turn, trim(text) AS k, role FROM conversations),
l AS (SELECT k, arg_max(role || ':' || conv_id, conv_id * 1000 + turn) AS fr FROM p GROUP BY k)
SELECT p.conv_id, p.turn, coalesce(l.fr, 'none') AS fr FROM p LEFT JOIN l ON p.k = l.k""")
def q_exact_text_align(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    pairs = turns.select(F.col("text").alias("en"), F.concat("role", F.lit(":"), F.col("conv_id").cast("string")).alias("fr"), (F.col("conv_id") * 1000 + F.col("turn")).alias("n"))
    aligned = seg.align_exact(turns.select("conv_id", "turn", F.col("text").alias("en")), pairs, "n")
    return aligned.select("conv_id", "turn", F.coalesce("fr", F.lit("none")).alias("fr"))
