"""Review of the store: search, rows for reviewers, inventories, decisions, purge of a key and of all that hangs on it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.text import without_gloss
from lexspark.operators.maintenance import commit, purge_senses, purge_types
from lexspark.operators.senses import diverse
from lexspark.operators.store import review_order

#: The columns of a row for reviewers, in their order, and those that the reviewer fills.
REVIEW_FIELDS = (
    "key", "kind", "lemmas_en", "pos", "definition_en", "occurrences", "agreement",
    "suggested_fr", "suggested_fr_alt", "omw_fr", "wonef", "frontier_confidence",
    "contexte_en", "sense_fit", "sense_fit_note",
    "definition_en_perso", "reassigner_vers", "fr_final", "fr_alt_final", "decision", "note",
)
TO_FILL = ("definition_en_perso", "reassigner_vers", "fr_final", "fr_alt_final", "decision", "note")
#: Shortest text that is searched for.
SHORTEST_QUERY = 2


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def search_store(store: DataFrame, query: str, limit: int = 30) -> DataFrame:
    """Entries that hold a text in key, lemmas, definition or translation, whatever the case; those with it in the key come first."""
    q = query.strip().lower()
    if len(q) < SHORTEST_QUERY:
        return store.limit(0)
    hay = F.lower(F.concat_ws(" ", "key", F.array_join(F.coalesce("lemmas_en", F.array().cast("array<string>")), " "), _text("definition_en"), _text("fr")))
    return store.where(F.contains(hay, F.lit(q))).orderBy(~F.contains(F.lower("key"), F.lit(q)), "key").limit(limit)


def search_senses(senses: DataFrame, query: str, limit: int = 40) -> DataFrame:
    """Senses (sense_id, pos, definition, lemmas, n their place in the inventory): those with the text as a lemma, then, up to the
    limit and in the inventory's order, those with a lemma that holds it; shown by part of speech and id."""
    q = query.strip().lower()
    if len(q) < SHORTEST_QUERY:
        return senses.limit(0)
    plain = F.transform("lemmas", lambda x: F.replace(F.lower(x), F.lit("_"), F.lit(" ")))
    exact = F.array_contains(plain, q.replace("_", " "))
    rows = senses.withColumn("__exact", exact).where(exact | F.exists(plain, lambda x: F.contains(x, F.lit(q))))
    shown = F.when(F.col("__exact"), F.struct("pos", "sense_id"))
    return rows.orderBy(F.desc("__exact"), shown, "n").limit(limit).orderBy("pos", "sense_id").drop("__exact")


def page_search(store: DataFrame, senses: DataFrame, query: str, own: DataFrame) -> DataFrame:
    """(origin, id): hits of the store, then of the inventory; a text that is too short shows the word's own inventory."""
    if len(query.strip()) < SHORTEST_QUERY:
        return own.select(F.lit("own").alias("origin"), F.col("sense_id").alias("id"))
    found = search_store(store, query).select(F.lit("store").alias("origin"), F.col("key").alias("id"))
    return found.unionByName(search_senses(senses, query).select(F.lit("inventory").alias("origin"), F.col("sense_id").alias("id")))


def split_inventory(inventory: DataFrame, word: str) -> tuple[DataFrame, DataFrame]:
    """(exact, approximate): senses (lemma) of the word itself, and those found by a base form."""
    same = F.lower(F.replace("lemma", F.lit("_"), F.lit(" "))) == word.lower()
    return inventory.where(same), inventory.where(~same)


def occurrences_by_sense(lines: DataFrame, expressions: DataFrame | None = None) -> DataFrame:
    """(key, segment, context, target_surface) of sense lines (best_sense, context, target_surface, word, segment) that name a sense, and of expressions."""
    target = F.coalesce(F.when(F.col("target_surface") != "", F.col("target_surface")), F.when(F.col("word") != "", F.col("word")))
    rows = lines.where((_text("best_sense") != "") & (F.col("best_sense") != "aucun_sens_adapte") & (_text("context") != "")).withColumn("t", target).where("t IS NOT NULL")
    found = rows.select(F.col("best_sense").alias("key"), F.coalesce("segment", F.lit(0)).cast("long").alias("segment"), "context", F.col("t").alias("target_surface"))
    return found if expressions is None else found.unionByName(expressions.select(found.columns))


def contexts(occurrences: DataFrame, most: int = 3) -> DataFrame:
    """(key, contexte_en): evenly spread sentences of each key, in order."""
    few = diverse(occurrences, ["key"], ["segment", "context"], most)
    return few.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "context"))), lambda x: x["context"]), " || ").alias("contexte_en"))


def review_rows(store: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Entries as rows for reviewers: lists joined, evidence spread out, the columns to fill empty."""
    have = set(store.columns)
    joined = store.join(contexts(occurrences), "key", "left")
    lists = {"lemmas_en": ("lemmas_en", "/"), "suggested_fr_alt": ("fr_alt", "; "), "omw_fr": ("omw_fr", "; "), "wonef": ("wonef", "; ")}
    plain = {"suggested_fr": "fr"}

    def shown(name: str) -> Column:
        if name in TO_FILL:
            return F.lit("").alias(name)
        if name in lists:
            source, mark = lists[name]
            return (F.coalesce(F.array_join(source, mark), F.lit("")) if source in have else F.lit("")).alias(name)
        source = plain.get(name, name)
        return (F.coalesce(F.col(source).cast("string"), F.lit("")) if source in joined.columns else F.lit("")).alias(name)

    return joined.select(*map(shown, REVIEW_FIELDS))


def pending_rows(store: DataFrame, occurrences: DataFrame) -> DataFrame:
    return review_rows(review_order(store), occurrences)


def target_from_entry(store: DataFrame) -> DataFrame:
    """Entries as targets of translation."""
    return store.select("key", "kind", "lemmas_en", F.coalesce("occurrences", F.lit(0)).alias("occurrences"), "definition_en")


def to_classify(targets: DataFrame, store: DataFrame, retry_pending: bool = False, retry_agreement: str | None = None) -> DataFrame:
    """Targets that the store lacks; with retry_pending its open entries too, all or those of one agreement. Others are never asked again."""
    new = targets.join(store.select("key"), "key", "left_anti")
    if not retry_pending:
        return new
    open_ = store.where("status = 'pending'")
    if retry_agreement is not None:
        open_ = open_.where(F.col("agreement") == retry_agreement)
    return new.select("key", "kind", "lemmas_en", "occurrences", "definition_en").unionByName(target_from_entry(open_))


def insert_absent(store: DataFrame, entries: DataFrame) -> DataFrame:
    """The store with the entries whose keys it lacks."""
    return store.unionByName(entries.join(store.select("key"), "key", "left_anti").select(store.columns))


def classify_expressions(targets: DataFrame, votes: DataFrame) -> DataFrame:
    """Expressions always wait for a human; the votes (key, n, fr, stem) suggest: the first answer of the stem most often given, the others as alternatives, short ones first."""
    counted = votes.groupBy("key", "stem").agg(F.count("*").alias("c"), F.min("n").alias("first"), F.min_by("fr", "n").alias("fr"))
    best = counted.groupBy("key").agg(F.min(F.struct((-F.col("c")).alias("c"), "first", "fr")).alias("b")).select("key", F.col("b.fr").alias("fr"))
    others = votes.join(best.withColumnRenamed("fr", "best"), "key").where("fr <> best").groupBy("key").agg(F.collect_set("fr").alias("o"))
    alternatives = F.transform(F.array_sort(F.transform("o", lambda x: F.struct(F.length(x).alias("l"), x.alias("x")))), lambda x: x["x"])
    rows = targets.where("kind = 'mwe'").join(best, "key", "left").join(others.select("key", alternatives.alias("fr_alt")), "key", "left")
    return rows.withColumns({"fr_alt": F.coalesce("fr_alt", F.array().cast("array<string>")), "status": F.lit("pending"), "agreement": F.lit("mwe_sans_ressource")})


def judged_entries(store: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The store after the judge's verdicts (key, fr, fr_alt, confidence, no_equivalent) on open entries: a sure one rewrites the translation, without its gloss."""
    v = verdicts.select("key", F.col("fr").alias("v_fr"), F.col("fr_alt").alias("v_alt"), F.col("confidence").alias("v_sure"), F.col("no_equivalent").alias("v_none"), F.lit(True).alias("v"))
    rows = store.join(v, "key", "left")
    open_ = F.col("v").isNotNull() & F.col("status").isin("pending", "auto_llm")
    sure = open_ & ~F.col("v_none") & (F.col("v_sure") == "high")
    status = F.when(open_ & F.col("v_none"), "no_equivalent").when(sure, "auto_judged").when(open_, "pending").otherwise(F.col("status"))
    changed = {"status": status, "fr": F.when(sure, without_gloss(F.col("v_fr"))).otherwise(F.col("fr")), "fr_alt": F.when(sure, F.col("v_alt")).otherwise(F.col("fr_alt"))}
    return rows.select(*[changed.get(c, F.col(c)).alias(c) for c in store.columns])


@dataclass
class Purge:
    """after: the tables without the key; removed: rows gone from each; log: the row for the journal. Nothing is written by itself."""

    after: dict[str, DataFrame]
    removed: dict[str, int]
    log: DataFrame


def purge(key: str, tables: dict[str, DataFrame], reason: str = "", today: str = "", export: Callable[[dict[str, DataFrame]], DataFrame] | None = None) -> Purge:
    """Takes a key, and all that hangs on it, out of store, lock, corrections, senses, types, occurrences, suspects and adjudication.

    A type goes only if no sense of it is left; lines that couldn't be read stay as they are. The journal gets a row, `export`
    makes the list anew from what is left, and the review queue follows from the store. A key that the store lacks is an error.
    """
    store = tables["store"]
    if store.where(F.col("key") == key).limit(1).count() == 0:
        raise ValueError(f"no such key: {key!r}")
    other = lambda c: ~F.col(c).eqNullSafe(F.lit(key))
    senses = purge_senses(tables["senses"], key)
    after = {
        "store": store.where(other("key")),
        "lock": tables["lock"].where(other("key")),
        "corrections": tables["corrections"].where(other("wrong_sense_id") & other("new_key")),
        "senses": senses["kept"],
        "types": purge_types(tables["types"], senses["fully_removed"]),
        "occurrences": purge_types(tables["occurrences"], senses["fully_removed"]),
        "suspects": tables["suspects"].where(other("key")),
        "adjudication": tables["adjudication"].where(other("key")),
    }
    removed = {name: tables[name].count() - rows.count() for name, rows in after.items()}
    spark = store.sparkSession
    log = spark.createDataFrame([(key, reason, today, removed)], "key string, reason string, purged_at string, removed map<string, long>")
    if export is not None:
        after["export"] = export(after)
    after["queue"] = review_order(after["store"])
    return Purge(after, removed, log)


def handle_decision(store: DataFrame, decision: DataFrame, senses: DataFrame, today: str) -> tuple[int, dict, DataFrame]:
    """(code, answer, store) of one decision: 400 and the old store where the key is missing, nothing is decided or the decision is wrong; else 200."""
    row = decision.first()
    if row is None or not (row["key"] or "").strip():
        return 400, {"error": "no key"}, store
    if not (row["decision"] or "").strip() and not (row["reassigner_vers"] or "").strip():
        return 400, {"error": "nothing decided", "key": row["key"]}, store
    after, errors = commit(store, decision, senses, today)
    wrong = errors.first()
    if wrong is not None:
        return 400, {"error": wrong["result"], "key": row["key"]}, store
    return 200, {"key": row["key"], "remaining": after.where("status = 'pending'").count()}, after


def handle_purge(key: str | None, tables: dict[str, DataFrame], reason: str = "", today: str = "") -> tuple[int, dict, dict[str, DataFrame]]:
    if not (key or "").strip():
        return 400, {"error": "no key"}, tables
    try:
        done = purge(key.strip(), tables, reason.strip(), today)
    except ValueError as wrong:
        return 400, {"error": str(wrong), "key": key}, tables
    return 200, {"status": "purged", "key": key.strip(), "removed": done.removed}, done.after


def cases_from_store(store: DataFrame, occurrences: DataFrame, inventory: DataFrame, stratum: str) -> DataFrame:
    """Benchmark cases of entries at their occurrences: candidates of both resources in order, each once; expressions have no current sense."""
    none = F.array().cast("array<string>")
    listed = inventory.groupBy("lemma").agg(F.array_sort(F.collect_set(F.struct("pos", "sense_id", "definition"))).alias("inventory"))
    rows = occurrences.join(store, "key").withColumn("lemma", F.coalesce(F.get("lemmas_en", F.lit(0)), "target_surface", F.lit(""))).join(listed, "lemma", "left")
    pos = F.coalesce("pos", F.lit("mwe"))
    return rows.select(
        F.concat_ws(":", F.lit("store"), "key", F.col("segment").cast("string")).alias("case_id"), F.lit(stratum).alias("stratum"), F.col("key").alias("source_key"), F.col("status").alias("source_status"),
        F.col("agreement").alias("source_agreement"), "lemma", F.coalesce("target_surface", "lemma").alias("target_surface"), _text("context").alias("context"), pos.alias("analyzer_pos"), "inventory",
        F.array_distinct(F.concat(F.coalesce("omw_fr", none), F.coalesce("wonef", none))).alias("fr_candidates"),
        F.struct(pos.alias("pos"), F.when(F.col("kind") == "synset", F.col("key")).alias("sense_id"), _text("fr").alias("meaning_fr")).alias("current"),
    )


def cases_from_none(lines: DataFrame, inventory: DataFrame) -> DataFrame:
    """Benchmark cases of occurrences that no sense fitted."""
    listed = inventory.groupBy("lemma").agg(F.array_sort(F.collect_set(F.struct("pos", "sense_id", "definition"))).alias("inventory"))
    rows = lines.where("best_sense = 'aucun_sens_adapte'").withColumn("lemma", F.coalesce("word", "target_surface", F.lit(""))).join(listed, "lemma", "left")
    pos = F.coalesce("pos", F.lit("other"))
    return rows.select(
        F.concat_ws(":", F.lit("none"), "lemma", F.coalesce("pos", F.lit("None")), F.coalesce("segment", F.lit(0)).cast("string")).alias("case_id"), F.lit("aucun_sens_adapte").alias("stratum"), F.lit("aucun_sens_adapte").alias("source_key"),
        F.lit("rejected_s5").alias("source_status"), F.lit("aucun_sens_adapte").alias("source_agreement"), "lemma", F.coalesce("target_surface", "lemma").alias("target_surface"), _text("context").alias("context"),
        pos.alias("analyzer_pos"), "inventory", F.array().cast("array<string>").alias("fr_candidates"), F.struct(pos.alias("pos"), F.lit(None).cast("string").alias("sense_id"), F.lit("").alias("meaning_fr")).alias("current"),
    )
