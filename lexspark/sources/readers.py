"""Readers of the accepted file formats; each gives a DataFrame and drops, keeps or refuses bad rows as documented."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions.text import base_forms, expand_pos
from lexspark.operators.segment import block_pairs, last_wins, lines, play_segments

#: The levels that count.
LEVELS = ("A1", "A2", "B1", "B2", "C1", "C2")


class SourceAdapter(Protocol):
    """Turns a source file into segments (book, idx, en, kind, speaker)."""

    def segments(self, spark: SparkSession, path: str) -> DataFrame: ...


class PlayAdapter:
    """Plays as plain text: names in capitals, stage directions in parentheses."""

    def __init__(self, excluded: list[tuple[int, int]] = ()):
        self.excluded = list(excluded)

    def segments(self, spark: SparkSession, path: str) -> DataFrame:
        return play_segments(whole_texts(spark, path), "book", "text", self.excluded)


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(book, text): each file as one row, so that its lines keep their order."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("book"), F.col("value").alias("text"))


def ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(n, line): the lines of files of any size, read in splits; n orders them by file, split and place in the split."""
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    return spark.read.text(path).select(place.alias("n"), F.col("value").alias("line"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    return lines(whole_texts(spark, path), "book", "text")


# ---- bilingual pairs


def pairs_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """en and fr; blank lines are skipped, a bad line is an error."""
    return spark.read.schema("en string, fr string").json(path, mode="FAILFAST").select(F.trim("en").alias("en"), F.trim("fr").alias("fr"))


def is_tsv(spark: SparkSession, path: str, sample: int = 20) -> bool:
    """Whether the first lines that aren't empty have one tab each."""
    first = spark.read.text(path).where("trim(value) <> ''").limit(sample).select((F.length("value") - F.length(F.replace("value", F.lit("\t")))).alias("n")).collect()
    return bool(first) and all(r.n == 1 for r in first)


def pairs_tsv(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("en string, fr string").csv(path, sep="\t", quote="")
    return rows.select(F.trim("en").alias("en"), F.trim("fr").alias("fr"))


def pairs_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of lines between blank lines, English and French in turn; an odd last block is dropped."""
    raw = whole_texts(spark, path).select("book", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("n", "line")).withColumn("line", F.trim("line"))
    from pyspark.sql import Window as W

    marked = raw.withColumn("blank_before", F.coalesce(F.lag("line").over(W.partitionBy("book").orderBy("n")) == "", F.lit(True))).where("line <> ''")
    return block_pairs(marked, "book", "n", F.col("blank_before"), "line").select("en", "fr")


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Any of the three formats."""
    if path.endswith(".jsonl"):
        return pairs_jsonl(spark, path)
    return pairs_tsv(spark, path) if is_tsv(spark, path) else pairs_blocks(spark, path)


def first_existing(spark: SparkSession, candidates: list[str]) -> str | None:
    """The first path that exists, on whatever file system Spark reads."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in candidates:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            return path
    return None


# ---- lexical resources


def prevalence(spark: SparkSession, path: str, whole_counts: bool = False) -> DataFrame:
    """word, pknown, nobs, prevalence, zipf of a headerless file; rows with too few or bad numbers are skipped, the last of equal words counts.

    whole_counts refuses counts that are written as decimals.
    """
    parts = ordered_lines(spark, path).select("n", F.split("line", ",").alias("p")).where("size(p) >= 5")
    at = lambda k: F.trim(F.element_at("p", k))
    nobs = at(3).try_cast("int") if whole_counts else at(3).try_cast("double").cast("int")
    rows = parts.select("n", F.lower(at(1)).alias("word"), at(2).try_cast("double").alias("pknown"), nobs.alias("nobs"), at(4).try_cast("double").alias("prevalence"), at(5).try_cast("double").alias("zipf"))
    good = rows.where("word <> '' AND pknown IS NOT NULL AND nobs IS NOT NULL AND prevalence IS NOT NULL AND zipf IS NOT NULL")
    return last_wins(good, "word", "n").drop("n")


def graded_words(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """word, pos, levels of a list with headword, pos and CEFR columns; levels of a word and pos are united."""
    rows = spark.read.csv(path, header=True, sep=sep)
    names = {c.strip("﻿ ").lower(): c for c in rows.columns}
    col = lambda n: F.trim(F.col(f"`{names[n]}`"))
    clean = rows.select(F.lower(col("headword")).alias("word"), F.lower(col("pos")).alias("pos"), F.upper(col("cefr")).alias("level")).where("word <> ''")
    return clean.groupBy("word", "pos").agg(F.array_sort(F.collect_set("level")).alias("levels"))


def graded_variants(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """As graded_words, with a/b headwords as two words and known levels only."""
    rows = graded_words(spark, path, sep).select(F.explode(F.split("word", "/")).alias("word"), "pos", F.explode("levels").alias("level"))
    known = rows.withColumn("word", F.trim("word")).where(F.col("level").isin(*LEVELS) & (F.col("word") != ""))
    return known.groupBy("word", "pos").agg(F.array_sort(F.collect_set("level")).alias("levels"))


def ages(spark: SparkSession, path: str) -> DataFrame:
    """word, aoa; rows without a number are skipped, the last of equal words counts."""
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at")).alias("n")
    clean = spark.read.csv(path, header=True).select(place, F.lower(F.trim("Word")).alias("word"), F.col("`Rating.Mean`").try_cast("double").alias("aoa")).where("word <> '' AND aoa IS NOT NULL")
    return last_wins(clean, "word", "n").drop("n")


def word_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).where("word <> ''").distinct()


def list_tiers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word string, zipf double, list_count int").csv(path, sep="\t")


def wordnet_literals(spark: SparkSession, path: str) -> DataFrame:
    """sense_id, literals of an XML lexicon with SYNSET, SYNONYM and LITERAL elements, without empty marks."""
    rows = spark.read.format("xml").option("rowTag", "SYNSET").schema("ID string, SYNONYM struct<LITERAL: array<string>>").load(path)
    kept = F.filter(F.transform("SYNONYM.LITERAL", lambda x: F.trim(x)), lambda x: (x != "") & (x != "_EMPTY_"))
    return rows.select(F.col("ID").alias("sense_id"), kept.alias("literals")).where("size(literals) > 0")


def apertium(spark: SparkSession, path: str) -> DataFrame:
    """en, fr of a bilingual dictionary: blanks are written as elements, grammar elements are ignored."""
    pieces = spark.read.option("lineSep", "</e>").text(path).select(F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at")).alias("n"), "value")
    entries = pieces.select("n", F.regexp_extract("value", r"(?s)<e[ >].*$", 0).alias("e")).where("e <> ''")  # an entry a piece, so files are read in splits

    def side(tag: str):
        inner = F.regexp_extract("e", rf"(?s)<{tag}>(.*?)</{tag}>", 1)
        return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(inner, r"<b\s*/>", " "), r"<[^>]*>", ""), r"\s+", " "))

    rows = entries.select(F.lower(side("l")).alias("en"), side("r").alias("fr"), "n").where("en <> '' AND fr <> ''")
    first = rows.groupBy("en", "fr").agg(F.min("n").alias("n"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("n", "fr"))), lambda x: x["fr"])
    return first.groupBy("en").agg(ordered.alias("fr"))


def dbnary(spark: SparkSession, path: str, lemmas: DataFrame | None = None) -> DataFrame:
    """gloss_id, lemma, pos, gloss_en, fr of a Turtle extract: glosses and translations are two selections of the stanzas, joined by gloss.

    lemmas (lemma) restricts the glosses before the join.
    """
    stanzas = spark.read.option("lineSep", ".\n").text(path).select(F.btrim("value", F.lit(" \n\r\t")).alias("s"))  # a stanza a row, so files are read in splits
    ident = F.regexp_extract("s", r"^eng:__en_gloss_(\S+)", 1)
    glosses = stanzas.where(ident != "").select(ident.alias("gloss_id"), F.regexp_extract("s", r'rdf:value\s+"((?:[^"\\]|\\.)*)"', 1).alias("gloss_en"))
    key = r"^(\d+)_(.+)__([A-Za-z_]+?)__(\d+)$"
    glosses = glosses.select("gloss_id", "gloss_en", F.lower(F.replace(F.regexp_extract("gloss_id", key, 2), F.lit("_"), F.lit(" "))).alias("lemma"), F.regexp_extract("gloss_id", key, 3).alias("pos"))
    if lemmas is not None:
        glosses = glosses.join(lemmas, "lemma", "left_semi")
    translated = stanzas.where(F.col("s").startswith("eng:__tr_fra_")).select(
        F.regexp_extract("s", r"dbnary:gloss\s+eng:__en_gloss_(\S+)", 1).alias("gloss_id"),
        F.regexp_extract("s", r'dbnary:writtenForm\s+"((?:[^"\\]|\\.)*)"@fr', 1).alias("fr"),
    ).where("fr <> ''")
    return glosses.join(translated.groupBy("gloss_id").agg(F.array_sort(F.collect_set("fr")).alias("fr")), "gloss_id", "left")


def sense_keys(spark: SparkSession, path: str) -> DataFrame:
    """lemma, instance, sense_key, file; lines with fewer than three fields are skipped."""
    parts = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("p"), F.col("_metadata.file_path").alias("file")).where("size(p) >= 3")
    return parts.select(F.get("p", F.lit(0)).alias("lemma"), F.get("p", F.lit(1)).alias("instance"), F.get("p", F.lit(2)).alias("sense_key"), "file")


def word_keys(spark: SparkSession, folder: str, word: str) -> DataFrame:
    """The sense keys of a word's own files: those named exactly WORD.key in the folder's parts of speech; a longer name is another word's."""
    name = f"{word.strip().lower().replace(' ', '_')}.key"
    own = F.lower(F.element_at(F.split("file", "/"), -1)) == name
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.key")
    parts = reader.text(folder).select(F.split(F.trim("value"), r"\s+").alias("p"), F.col("_metadata.file_path").alias("file")).where(own & (F.size("p") >= 3))
    return parts.select(F.get("p", F.lit(0)).alias("lemma"), F.get("p", F.lit(1)).alias("instance"), F.get("p", F.lit(2)).alias("sense_key"), "file")


def sense_counts(keys: DataFrame, index: DataFrame) -> DataFrame:
    """(sense_id, n): occurrences of each sense by an index (sense_key, sense_id); keys that it lacks are counted under null."""
    counted = keys.groupBy("sense_key").agg(F.count("*").alias("k"))
    return counted.join(index, "sense_key", "left").groupBy("sense_id").agg(F.sum("k").alias("n"))


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, message) of transcripts with elements that can't be read."""
    rows = spark.read.format("xml").option("rowTag", "u").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "bad").schema("_n string, bad string").load(path)
    return rows.where("bad IS NOT NULL").groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("_n").alias("first"), F.concat(F.count("*").cast("string"), F.lit(" unreadable elements")).alias("message"))


def spoken_words(spark: SparkSession, path: str) -> DataFrame:
    """file, utterance, who, pos_in, surface, lemma, pos, class, usas of transcript XML; words without text are dropped."""
    word = "struct<_VALUE: string, _lemma: string, _pos: string, _class: string, _usas: string>"
    rows = spark.read.format("xml").option("rowTag", "u").option("mode", "DROPMALFORMED").schema(f"_n string, _who string, w array<{word}>").load(path)
    flat = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_n").alias("utterance"), F.col("_who").alias("who"), F.posexplode("w").alias("pos_in", "w"))
    cols = [F.trim("w._VALUE").alias("surface"), F.lower("w._lemma").alias("lemma"), F.col("w._pos").alias("pos"), F.col("w._class").alias("class"), F.col("w._usas").alias("usas")]
    return flat.select("file", "utterance", "who", "pos_in", *cols).where("surface <> ''")


def synsets(senses: DataFrame, words: DataFrame) -> DataFrame:
    """Senses (sense_id, lemma, pos) of words (word, pos) in order; adjectives take satellites, and the lemma must be the word itself."""
    wanted = words.select(F.col("word").alias("lemma"), F.explode(expand_pos(F.col("pos"))).alias("pos")).distinct()
    return senses.join(wanted, ["lemma", "pos"]).orderBy("lemma", "pos", "sense_id")


def open_inventory(senses: DataFrame, word: str) -> DataFrame:
    """All senses of a word or of its base forms, of every part of speech, by part of speech and id."""
    forms = F.transform(base_forms(F.lit(word.strip().lower().replace(" ", "_"))), F.lower)
    return senses.where(F.array_contains(forms, F.lower(F.replace("lemma", F.lit(" "), F.lit("_"))))).dropDuplicates(["sense_id"]).orderBy("pos", "sense_id")


# ---- own files


def tolerant_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows with a raw column that holds the line where it couldn't be read."""
    reader = spark.read.schema(f"{schema}, raw string").option("allowUnquotedControlChars", "true")
    return reader.json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="raw")


def strict_jsonl(spark: SparkSession, path: str, schema: str, key: str | None = None) -> DataFrame:
    """A bad line is an error; with a key the last row of equal keys counts."""
    if key is None:
        return spark.read.schema(schema).json(path, mode="FAILFAST")
    from pyspark.sql.types import StructType

    raw = ordered_lines(spark, path).withColumnRenamed("n", "__n").where("trim(line) <> ''")
    rows = raw.select("__n", F.from_json("line", StructType.fromDDL(schema), {"mode": "FAILFAST"}).alias("r")).select("__n", "r.*")
    return last_wins(rows, key, "__n").drop("__n")


def custom_idioms(entries: DataFrame) -> DataFrame:
    return entries.where("kind = 'idiom'").select("lemma", "definition_en")


def tokenizer_surfaces(entries: DataFrame) -> DataFrame:
    return entries.where("kind = 'tokenizer'").select(F.explode("surfaces").alias("surface")).distinct()


def with_custom(base: DataFrame, custom: DataFrame) -> DataFrame:
    """Definitions (lemma, definition_en), custom ones instead of base ones."""
    b, c = base.withColumnRenamed("definition_en", "b"), custom.withColumnRenamed("definition_en", "c")
    return b.join(c, "lemma", "full_outer").select("lemma", F.coalesce("c", "b").alias("definition_en"))
