"""Outside answers: questions, the table of kept answers, and a client for those still to ask."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.operators.store import batches


def translation_prompt(lemmas: Column, pos: Column, definition: Column, examples: Column) -> Column:
    """The question about one sense."""
    parts = [
        F.concat(F.lit("Words: "), F.array_join(lemmas, ", ")),
        F.concat(F.lit("Part of speech: "), F.coalesce(pos, F.lit("-"))),
        F.concat(F.lit("Definition: "), F.coalesce(definition, F.lit("-"))),
        F.concat(F.lit("Examples: "), F.array_join(examples, " || ")),
    ]
    return F.concat_ws("\n", *parts)


def numbered_batches(questions: DataFrame, kind: str, key: str, size: int) -> DataFrame:
    """Questions in batches of one kind, numbered within it."""
    return batches(questions, kind, key, size)


def ask(questions: DataFrame, client: Callable[[list[str]], list[str | None]], key: str = "key", prompt: str = "prompt", at_once: int = 40) -> DataFrame:
    """(key, answer) by a client that answers a list of prompts; a list that fails has null answers and fails no other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                part = batch.slice(at, at_once)
                try:
                    answers = client(part.column(1).to_pylist())
                except Exception:  # one failed request must not end the job
                    answers = [None] * part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(answers, pa.string())], names=[key, "answer"])

    kind = questions.schema[key].dataType.simpleString()
    return questions.select(key, prompt).mapInArrow(run, f"{key} {kind}, answer string")


def with_answers(questions: DataFrame, answers: DataFrame, key: str = "key") -> DataFrame:
    """Questions with their answers; an answer to no question is left out, a question without one has null."""
    return questions.join(answers, key, "left")


def unusable(answers: DataFrame, inventory: DataFrame, key: str = "key") -> DataFrame:
    """Answers (key, sense_id) whose sense is missing or not in the key's inventory (key, sense_id)."""
    return answers.where("sense_id IS NULL").unionByName(answers.where("sense_id IS NOT NULL").join(inventory, [key, "sense_id"], "left_anti").select(*answers.columns))


def vote(answers: DataFrame, stem: Column, key: str = "key", least: int = 2) -> DataFrame:
    """(key, stem, n): the stem that most of a key's answers share, if at least `least` do; of equals the first asked (column n_asked)."""
    counted = answers.where("answer IS NOT NULL AND trim(answer) <> ''").groupBy(key, stem.alias("stem")).agg(F.count("*").alias("n"), F.min("n_asked").alias("first"))
    best = counted.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), "first", "stem")).alias("b"))
    return best.select(key, "b.stem", (-F.col("b.n")).alias("n")).where(F.col("n") >= least)


def reassignment_prompt(key: Column, kind: Column, lemmas: Column, pos: Column, definition: Column, inventory: Column, examples: Column) -> Column:
    """The question whether an entry has the right sense; inventory is an array of (sense_id, pos, definition)."""
    head = F.concat(F.lit("- "), key, F.lit(" | words: "), F.array_join(lemmas, "/"), F.lit(" | current part of speech: "), F.coalesce(pos, F.lit("mwe")), F.lit(" | definition: "), F.coalesce(definition, F.lit("?")))
    senses = F.transform(inventory, lambda s: F.concat(F.lit("    candidate: "), s["sense_id"], F.lit(" | "), s["pos"], F.lit(" | "), s["definition"]))
    told = F.when(kind == "mwe", F.lit("    (fixed expression: no inventory)")).otherwise(F.array_join(senses, "\n"))
    return F.concat_ws("\n", head, told, F.array_join(F.transform(examples, lambda e: F.concat(F.lit("    seen: "), e)), "\n"))


def arbitration_prompt(word: Column, pos: Column, context: Column, inventory: Column) -> Column:
    """The question which sense of an inventory (sense_id, definition) a word has in its context."""
    senses = F.array_join(F.transform(inventory, lambda s: F.concat(F.lit("- "), s["sense_id"], F.lit(": "), s["definition"])), "\n")
    return F.concat(F.lit("Word: "), word, F.lit(" ("), pos, F.lit(")\nContext: "), context, F.lit("\nSenses:\n"), senses)


def parsed(answers: DataFrame, ddl: str, required: tuple[str, ...]) -> DataFrame:
    """Answers (key, answer) read as JSON of ddl; value is null where the text is no such object or a required field is missing."""
    value = F.from_json("answer", ddl)
    whole = F.lit(True)
    for name in required:
        whole = whole & value[name].isNotNull()
    return answers.withColumn("value", F.when(whole, value))


def total_cost(batches_: DataFrame) -> DataFrame:
    """One row: what all batches (cost, failed) cost, and how many failed; a failed one ends nothing."""
    return batches_.agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost"), F.count_if("failed").alias("n_failed"))
