"""The corpus pipeline: quality rules, near duplicates, benchmark passages, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm import decontam, packing, pii_crf, quality_bands, simhash
from lexspark.llm.common import checkpointed, fresh_name, table
from lexspark.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts have no words and go; repeated rows are judged row by
    row, very long texts whole. An empty table stays empty, further columns of any name pass through."""
    name = fresh_name(docs, "__quality")
    return docs.select("*", quality_bands.quality_column(F.col("text")).alias(name)).where(F.col(name)["kept"]).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that of the smallest doc_id. Null and empty texts are one component;
    repeated rows leave one; where a doc_id repeats with different texts, each text is its own row. A component without any
    doc_id leaves one row. An empty table stays empty, further columns of any name pass through."""
    return simhash.keep_representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window. Null and empty texts have no words and stay; repeated rows are judged row by row,
    very long texts whole. An empty table stays empty, an empty benchmark leaves all, further columns of any name pass through."""
    name = fresh_name(docs, "__hits")
    hits = decontam.benchmark_hits(docs, table(spark, sf_dir, "benchmark"), name)
    return hits.where(~decontam.contaminated(F.col(name))).drop(name)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars, where there is one, counts the new text. Null texts
    stay null, empty ones empty; repeated rows are judged row by row, very long texts whole. An empty table stays empty,
    further columns of any name pass through."""
    text = pii_crf.redact_column(F.col("text"))
    name = fresh_name(docs, "__text")
    found = docs.select("*", text.alias(name))
    new = {"text": F.col(name)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(name).cast(docs.schema["n_chars"].dataType)
    return found.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences. Null and empty texts are the end token alone; repeated rows are packed row by
    row, very long texts in pieces. An empty table gives no rows; only doc_id and text are read."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("best-fit packing", best_fit_packing),
]
#: The compression ratios, fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to the documents, each over what the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
