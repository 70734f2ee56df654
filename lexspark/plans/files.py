"""Readers and writers: files made from the driver's tables in the shared folder, read back by the readers, against SQL over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.checkpoints import shared_folder
from lexspark.functions import text as T
from lexspark.plans.lexicon import UNITS_SQL, text_words, units, words_sql
from lexspark.plans.registry import query, table
from lexspark.sources import readers, sinks


def folder(spark: SparkSession) -> str:
    """A new path in the cluster's shared folder."""
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def written(rows: DataFrame, line: Column, *order: str) -> str:
    """The path of text files with a line for each row; files and lines are in order."""
    path = folder(rows.sparkSession)
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order) if order else rows
    ranged.select(line.cast("string").alias("value")).write.text(path)
    return path


@query(f"""SELECT word, CAST(0.95 AS DOUBLE) AS pknown, CAST(n AS INT) AS nobs, CAST(3.5 AS DOUBLE) AS zipf FROM {words_sql('conversations')}""")
def q_read_prevalence(spark: SparkSession, sf: str) -> DataFrame:
    """Each word three times: with too few fields, with an old count, and as it is; the last good line counts."""
    rows = text_words(spark, sf, "conversations").select("word", "n", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
    line = F.when(F.col("k") == 0, F.concat_ws(",", "word", "n")).when(F.col("k") == 1, F.concat(F.upper("word"), F.lit(",0.5,1.0,0.1,1"))).otherwise(F.concat("word", F.lit(", 0.95,"), F.col("n").cast("string"), F.lit(".0,0.2,3.5")))
    return readers.prevalence(spark, written(rows, line, "word", "k")).select("word", "pknown", "nobs", "zipf")


PAIR_SQL = "SELECT 'item ' || item_id AS en, array_to_string(regexp_extract_all(lower(text), '[a-z]+'), ' ') AS fr FROM benchmark"


@query(PAIR_SQL)
def q_read_pairs_tsv(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "benchmark").select(F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("en"), F.array_join(T.words(F.col("text")), " ").alias("fr"))
    return readers.read_pairs(spark, written(rows, F.concat_ws("\t", F.concat(F.lit(" "), "en"), "fr")))


@query(PAIR_SQL)
def q_read_pairs_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "benchmark").select(F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("en"), F.concat(F.array_join(T.words(F.col("text")), " "), F.lit(" ")).alias("fr"))
    return readers.pairs_jsonl(spark, written(rows, F.to_json(F.struct("en", "fr"))))


@query(f"""WITH b AS (SELECT word, n, CASE n % 3 WHEN 0 THEN 'noun' ELSE 'verb' END AS pos FROM {words_sql('benchmark')})
SELECT word, pos, CASE WHEN length(word) % 2 = 0 THEN 'A1/C2' ELSE 'C2' END AS levels FROM b""")
def q_read_graded(spark: SparkSession, sf: str) -> DataFrame:
    """A line or two for each word; levels are united, one that isn't known goes."""
    rows = text_words(spark, sf, "benchmark").select("word", F.when(F.col("n") % 3 == 0, "noun").otherwise("verb").alias("pos"), F.explode(F.when(F.length("word") % 2 == 0, F.array(F.lit("c2"), F.lit("A1"))).otherwise(F.array(F.lit("C2"), F.lit("Z9")))).alias("level"))
    path = folder(spark)
    rows.select(F.initcap("word").alias("headword"), "pos", F.col("level").alias("CEFR")).write.csv(path, header=True)
    return readers.graded_variants(spark, path).select("word", "pos", F.array_join("levels", "/").alias("levels"))


@query(f"""SELECT word, CAST(length(word) + 0.5 AS DOUBLE) AS aoa FROM {words_sql('benchmark')} WHERE n % 4 <> 0""")
def q_read_ages(spark: SparkSession, sf: str) -> DataFrame:
    rows = text_words(spark, sf, "benchmark").select(F.col("word").alias("Word"), F.when(F.col("n") % 4 == 0, "NA").otherwise((F.length("word") + 0.5).cast("string")).alias("Rating.Mean"))
    path = folder(spark)
    rows.write.csv(path, header=True)
    return readers.ages(spark, path)


@query("""SELECT source AS lemma, 'd' || doc_id AS instance, lang || '%' || n_chars AS sense_key FROM documents WHERE lang <> 'de'""")
def q_read_sense_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with two fields only are left out."""
    key = F.concat(F.lit(" "), "lang", F.lit("%"), F.col("n_chars").cast("string"), F.lit(" more"))
    path = written(table(spark, sf, "documents"), F.concat("source", F.lit(" d"), F.col("doc_id").cast("string"), F.when(F.col("lang") != "de", key).otherwise("")))
    return readers.sense_keys(spark, path).drop("file")


@query("""WITH w AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM benchmark), p AS (SELECT DISTINCT w[i] || ' up' AS en, 'f' || item_id AS fr, item_id FROM (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS i FROM w))
SELECT en, string_agg(fr, '/' ORDER BY item_id) AS fr FROM p GROUP BY en""")
def q_read_apertium(spark: SparkSession, sf: str) -> DataFrame:
    """An entry for each word of an item, repeated ones too; translations in order, each once."""
    rows = table(spark, sf, "benchmark").select("item_id", F.posexplode(T.words(F.col("text"))).alias("pos", "w"))
    entry = F.concat(F.lit('<e><p><l>'), F.initcap("w"), F.lit('<b/>up<s n="v"/></l><r>f'), F.col("item_id").cast("string"), F.lit('<s n="v"/></r></p></e>'))
    return readers.apertium(spark, written(rows, entry, "item_id", "pos")).select("en", F.array_join("fr", "/").alias("fr"))


@query("""SELECT item_id || '_big_cat__Noun__1' AS gloss_id, 'big cat' AS lemma, 'Noun' AS pos, array_to_string(regexp_extract_all(lower(text), '[a-z]+'), ' ') AS gloss_en, 'chat ' || item_id || '/lion' AS fr FROM benchmark""")
def q_read_dbnary(spark: SparkSession, sf: str) -> DataFrame:
    """A gloss and two translations for each item, as stanzas."""
    ident = F.concat(F.col("item_id").cast("string"), F.lit("_big_cat__Noun__1"))
    gloss = F.concat(F.lit("eng:__en_gloss_"), ident, F.lit(' a dbnary:Gloss ;\n  rdf:value "'), F.array_join(T.words(F.col("text")), " "), F.lit('"@en .'))
    said = lambda k, fr: F.concat(F.lit(f"eng:__tr_fra_{k}_"), ident, F.lit(" a dbnary:Translation ;\n  dbnary:gloss eng:__en_gloss_"), ident, F.lit(' ;\n  dbnary:writtenForm "'), fr, F.lit('"@fr .'))
    rows = table(spark, sf, "benchmark").select(F.explode(F.array(gloss, said(1, F.concat(F.lit("chat "), F.col("item_id").cast("string"))), said(2, F.lit("lion")))).alias("stanza"))
    return readers.dbnary(spark, written(rows, F.col("stanza"))).select("gloss_id", "lemma", "pos", "gloss_en", F.array_join("fr", "/").alias("fr"))


@query("""SELECT 'eng-30-' || item_id || '-n' AS sense_id, array_to_string(regexp_extract_all(lower(text), '[a-z]+'), '/') AS literals FROM benchmark""")
def q_read_wordnet_xml(spark: SparkSession, sf: str) -> DataFrame:
    literals = F.concat(F.array(F.lit("_EMPTY_")), F.transform(T.words(F.col("text")), lambda w: F.concat(F.lit(" "), w)))
    rows = table(spark, sf, "benchmark").select(F.concat(F.lit("eng-30-"), F.col("item_id").cast("string"), F.lit("-n")).alias("ID"), F.struct(literals.alias("LITERAL")).alias("SYNONYM"))
    path = folder(spark)
    rows.write.format("xml").option("rootTag", "R").option("rowTag", "SYNSET").save(path)
    return readers.wordnet_literals(spark, path).select("sense_id", F.array_join("literals", "/").alias("literals"))


@query("""WITH w AS (SELECT conv_id, turn, role, regexp_extract_all(lower(text), '[a-z]+') AS w FROM conversations) SELECT 'c' || conv_id || 't' || turn AS utterance, role AS who, unnest(range(len(w))) AS pos_in, unnest(w) AS surface, upper(left(unnest(w), 1)) AS pos FROM w""")
def q_read_spoken(spark: SparkSession, sf: str) -> DataFrame:
    one = lambda w: F.struct(w.alias("_VALUE"), F.upper(F.substring(w, 1, 1)).alias("_pos"), w.alias("_lemma"))
    name = F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("t"), F.col("turn").cast("string"))
    turns = table(spark, sf, "conversations").select(name.alias("_n"), F.col("role").alias("_who"), F.transform(T.words(F.col("text")), one).alias("w"))
    path = folder(spark)
    turns.write.format("xml").option("rootTag", "text").option("rowTag", "u").save(path)
    return readers.spoken_words(spark, path).select("utterance", "who", "pos_in", "surface", "pos")


@query("""SELECT lang || source AS key, max(doc_id) AS doc_id FROM documents GROUP BY 1""")
def q_read_store(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines of which the last of equal keys counts."""
    rows = table(spark, sf, "documents").select(F.concat("lang", "source").alias("key"), "doc_id")
    return readers.strict_jsonl(spark, written(rows, F.to_json(F.struct("key", "doc_id")), "doc_id"), "key string, doc_id long", "key")


@query("""SELECT CASE WHEN lang = 'de' THEN '-' ELSE source END AS source, CASE WHEN lang = 'de' THEN '{broken ' || doc_id ELSE '-' END AS raw FROM documents""")
def q_read_tolerant(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that can't be read are kept as they are."""
    rows = table(spark, sf, "documents")
    line = F.when(F.col("lang") == "de", F.concat(F.lit("{broken "), F.col("doc_id").cast("string"))).otherwise(F.to_json(F.struct("source")))
    found = readers.tolerant_jsonl(spark, written(rows, line), "source string")
    return found.select(F.coalesce("source", F.lit("-")).alias("source"), F.coalesce("raw", F.lit("-")).alias("raw"))


@query(f"""WITH {UNITS_SQL} SELECT word AS canonical_form, book_count, dispersion, round(score_comprehension, 3) AS score_comprehension, '-' AS sense_id FROM units""")
def q_write_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The exported list, written and read again: all columns in order, empty where there is no value, scores rounded."""
    path = folder(spark)
    sinks.write_csv(units(spark, sf).withColumnRenamed("word", "canonical_form"), path)
    kinds = {"book_count": "long", "dispersion": "long"} | {c: "double" for c in sinks.SCORES}
    read = spark.read.schema(", ".join(f"{c} {kinds.get(c, 'string')}" for c in sinks.EXPORT)).csv(path, header=True, enforceSchema=False)
    return read.select("canonical_form", "book_count", "dispersion", F.round("score_comprehension", 3).alias("score_comprehension"), F.coalesce("sense_id", F.lit("-")).alias("sense_id"))


@query("""SELECT 'k' || doc_id AS key, quality, toxic FROM labels""")
def q_write_store(spark: SparkSession, sf: str) -> DataFrame:
    """The store written twice in one place, then read."""
    rows = table(spark, sf, "labels").select(F.concat(F.lit("k"), F.col("doc_id").cast("string")).alias("key"), "quality", "toxic")
    path = folder(spark)
    for part in (rows.limit(3), rows):
        sinks.write_store(part, path)
    return readers.strict_jsonl(spark, path, "key string, quality long, toxic long", "key")
