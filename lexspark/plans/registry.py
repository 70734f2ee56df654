"""Where queries register themselves with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexspark.functions.text import FRONT_MATTER

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Words with their places, in SQL.
WORDS_SQL = """docw AS (SELECT doc_id, lang, source, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents),
tok AS (SELECT doc_id, lang, source, unnest(w) AS word, unnest(range(len(w))) AS pos FROM docw)"""
#: Trimmed lines that aren't empty, in SQL.
LINES_SQL = """docl AS (SELECT doc_id, lang, source, string_split(text, chr(10)) AS l FROM documents),
rawline AS (SELECT doc_id, lang, source, trim(unnest(l)) AS line, unnest(range(1, len(l) + 1)) AS line_no FROM docl),
lines AS (SELECT * FROM rawline WHERE line <> '')"""
FRONT_SQL = f"regexp_matches(line, '{FRONT_MATTER}')"
NAME_SQL = r"""(regexp_matches(line, '\p{Lu}') AND NOT regexp_matches(line, '\p{Ll}') AND length(line) < 40)"""
KIND_SQL = rf"""CASE WHEN {FRONT_SQL} THEN 'hors_oeuvre'
  WHEN (starts_with(line, '(') AND ends_with(line, ')')) OR regexp_matches(line, '^[A-Z][a-z]+ (walks|enters|exits|sits|stands|stares|looks)\b') THEN 'didascalie' ELSE 'dialogue' END"""
NWORDS_SQL = r"len(regexp_extract_all(line, '\S+'))"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
