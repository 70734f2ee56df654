"""Changes of the store: human decisions, re-keying, purges, adjudication, evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexspark.functions.text import any_match, head_stem, readable_content_words, same_pos, sense_pos
from lexspark.operators.store import EXPORTABLE, first_match

#: Pending agreements that ask for a new sense.
STRUCTURAL = ("sense_id_suspect", "sense_id_douteux", "frontier_reformulation", "frontier_explicitation")
#: Labels of expressions that may be keys.
EXPRESSION_LABELS = ("idiome", "phrasal_verb", "semi_fige")
#: The dimensions of a judgment.
DIMENSIONS = ("pos_correct", "sense_correct", "fr_acceptable", "overall")


def reassign_targets(store: DataFrame) -> DataFrame:
    """Pending entries whose sense is in doubt, by key."""
    return store.where((F.col("status") == "pending") & F.col("agreement").isin(*STRUCTURAL)).orderBy("key")


def classify_decisions(decisions: DataFrame, store: DataFrame, inventory: DataFrame) -> DataFrame:
    """outcome of each decision (key, sense_id, fr): promu, reassigne, bloque or audit.

    Expressions keep their key. A sense that the inventory lacks is taken as none. A move to another part of
    speech is for a human, satellites being adjectives. A locked target is never overwritten.
    """
    known = inventory.select("sense_id").distinct().withColumn("known", F.lit(True))
    entry = store.select("key", "kind", F.col("pos").alias("entry_pos"))
    target = store.select(F.col("key").alias("sense_id"), F.col("status").alias("target_status"))
    rows = decisions.join(entry, "key").join(known, "sense_id", "left")
    rows = rows.withColumn("sense_id", F.when(F.coalesce("known", F.lit(False)) | (F.col("kind") == "mwe"), F.col("sense_id")))
    rows = rows.join(target, "sense_id", "left")
    outcome = first_match(
        (F.col("kind") == "mwe", "promu"),
        (F.col("sense_id").isNull(), "audit"),
        (~F.coalesce(same_pos(sense_pos(F.col("sense_id")), F.col("entry_pos")), F.lit(False)), "audit"),
        (F.col("sense_id") == F.col("key"), "promu"),
        (F.coalesce(F.col("target_status").isin(*EXPORTABLE), F.lit(False)), "bloque"),
        otherwise="reassigne",
    )
    return rows.select("key", "sense_id", "fr", outcome.alias("outcome"))


def apply_reassignments(store: DataFrame, classified: DataFrame) -> DataFrame:
    """The store after the decisions. Of several moves to one key the one from the smallest key counts."""
    moved = classified.where("outcome = 'reassigne'").groupBy("sense_id").agg(F.min(F.struct("key", "fr")).alias("m")).select("sense_id", F.col("m.key").alias("key"), F.col("m.fr").alias("new_fr"))
    promoted = classified.where("outcome = 'promu'").select("key", F.lit(True).alias("promoted"), F.col("fr").alias("fr_promoted"))
    away = moved.select("key", F.concat(F.lit("reassigne_vers:"), "sense_id").alias("moved_to"))
    kept = store.join(promoted, "key", "left").join(away, "key", "left")
    promote = F.col("promoted").isNotNull()
    changed = {
        "fr": F.when(promote, F.coalesce("fr_promoted", "fr")).otherwise(F.col("fr")),
        "status": F.when(promote, "auto_joint").otherwise(F.col("status")),
        "agreement": F.when(promote, "auto_joint_confirme").otherwise(F.coalesce("moved_to", "agreement")),
    }
    kept = kept.select(*[changed.get(c, F.col(c)).alias(c) for c in store.columns])
    origin = store.select("key", F.col("occurrences").alias("n"), F.col("lemmas_en").alias("l"))
    fresh = moved.join(origin, "key").select(F.col("sense_id").alias("key"), F.col("key").alias("from_key"), F.lit(True).alias("new"), "new_fr", "n", "l")
    both = kept.join(fresh, "key", "full_outer")
    new = F.col("new").isNotNull()
    none = F.array().cast("array<string>")
    word = F.array(F.replace(F.get(F.split("key", r"\."), F.lit(0)), F.lit("_"), F.lit(" ")))
    chosen = {
        "fr": F.when(new, F.col("new_fr")).otherwise(F.col("fr")),
        "status": F.when(new, "auto_joint").otherwise(F.col("status")),
        "agreement": F.when(new, F.concat(F.lit("auto_joint_reassigne_depuis:"), "from_key")).otherwise(F.col("agreement")),
        "occurrences": F.coalesce("occurrences", F.lit(0)) + F.coalesce("n", F.lit(0)),
        "kind": F.when(new, "synset").otherwise(F.col("kind")),
        "pos": F.when(new, sense_pos(F.col("key"))).otherwise(F.col("pos")),
        "lemmas_en": F.when(new, F.array_distinct(F.concat(F.coalesce("lemmas_en", none), word, F.coalesce("l", none)))).otherwise(F.col("lemmas_en")),
    }
    return both.select(*[chosen.get(c, F.col(c)).alias(c) for c in store.columns])


def judge_commits(decisions: DataFrame, store: DataFrame, senses: DataFrame) -> DataFrame:
    """result of each human decision (n, key, decision, reassigner_vers, fr_final): ok, no, none, reassigned, skipped or an error.

    senses (sense_id) holds the known senses; keys of expressions are mwe:EXPRESSION:LABEL.
    """
    clean = lambda c: F.coalesce(F.trim(c), F.lit(""))
    asked = decisions.withColumn("decision", F.lower(clean("decision"))).withColumn("to", clean("reassigner_vers")).withColumn("fr_final", clean("fr_final"))
    entry = store.select("key", F.lit(True).alias("found"), "kind", F.get("lemmas_en", F.lit(0)).alias("word"), "pos")
    known = senses.select(F.col("sense_id").alias("to")).distinct().withColumn("known", F.lit(True))
    rows = asked.join(entry, "key", "left").join(known, "to", "left")
    moving = F.col("to") != ""
    well_formed = F.coalesce("known", F.lit(False)) | F.col("to").rlike(f"^mwe:[^:]+:({'|'.join(EXPRESSION_LABELS)})$")
    result = first_match(
        ((F.col("decision") == "") & ~moving, "skipped"),
        (~F.col("decision").isin("ok", "no", "none"), "error: invalid decision"),
        (F.col("found").isNull(), "error: unknown key"),
        (moving & (F.col("kind") != "synset"), "error: only senses move"),
        (moving & (F.col("decision") != "ok"), "error: a move needs ok"),
        (moving & (F.col("fr_final") == ""), "error: a move needs a translation"),
        (moving & ~well_formed, "error: bad target"),
        (moving & (F.col("word").isNull() | F.col("pos").isNull()), "error: no word or part of speech"),
        (moving, "reassigned"),
        ((F.col("decision") == "ok") & (F.col("fr_final") == ""), "error: ok needs a translation"),
    )
    return rows.withColumn("result", F.coalesce(result, "decision"))


def commit(store: DataFrame, decisions: DataFrame, senses: DataFrame, today: str) -> tuple[DataFrame, DataFrame]:
    """(store, errors) after human decisions. A key's last good decision, by n, counts; a human may overwrite a locked target."""
    judged = judge_commits(decisions, store, senses)
    good = judged.where("NOT startswith(result, 'error') AND result <> 'skipped'")
    aim = good.withColumn("aim", F.when(F.col("result") == "reassigned", F.col("to")).otherwise(F.col("key")))
    last = aim.groupBy("aim").agg(F.max_by(F.struct("key", "result", "fr_final"), F.col("n")).alias("d")).select(F.col("aim").alias("key"), F.col("d.key").alias("from_key"), "d.result", F.col("d.fr_final").alias("new_fr"))
    origin = store.select(F.col("key").alias("from_key"), F.col("occurrences").alias("n"), F.lit(True).alias("o"))
    merged = store.join(last.join(origin, "from_key"), "key", "full_outer")
    hit, moved = F.col("result").isNotNull(), F.col("result") == "reassigned"
    status = F.when(F.col("result") == "no", "rejected").when(F.col("result") == "none", "no_equivalent").otherwise("validated")
    expression = F.col("key").startswith("mwe:")
    word = F.when(expression, F.get(F.split("key", ":"), F.lit(1))).otherwise(F.replace(F.get(F.split("key", r"\."), F.lit(0)), F.lit("_"), F.lit(" ")))
    chosen = {
        "status": F.when(hit, status).otherwise(F.col("status")),
        "fr": F.when(hit, F.when(F.col("result").isin("ok", "reassigned"), F.col("new_fr"))).otherwise(F.col("fr")),
        "agreement": F.when(moved, F.concat(F.lit("reassigne_manuellement_depuis:"), "from_key")).otherwise(F.col("agreement")),
        "occurrences": F.when(moved, F.col("n")).otherwise(F.col("occurrences")),
        "kind": F.when(moved, F.when(expression, "mwe").otherwise("synset")).otherwise(F.col("kind")),
        "pos": F.when(moved, F.when(expression, "mwe").otherwise(sense_pos(F.col("key")))).otherwise(F.col("pos")),
        "lemmas_en": F.when(moved, F.array(word)).otherwise(F.col("lemmas_en")),
        "decided_by": F.when(hit, "human").otherwise(F.col("decided_by")),
        "decided_at": F.when(hit, today).otherwise(F.col("decided_at")),
    }
    return merged.select(*[chosen.get(c, F.col(c)).alias(c) for c in store.columns]), judged.where("startswith(result, 'error')").select("key", "result")


def corrections(judged: DataFrame, store: DataFrame) -> DataFrame:
    """The corrections (word, pos, wrong_sense_id, new_key) that moves leave for the next book."""
    moves = judged.where("result = 'reassigned'").select("key", "to")
    return moves.join(store.select("key", F.get("lemmas_en", F.lit(0)).alias("word"), "pos"), "key").select("word", "pos", F.col("key").alias("wrong_sense_id"), F.col("to").alias("new_key"))


def flagged(store: DataFrame) -> DataFrame:
    """Locked entries whose sense doesn't fit and that no human decided."""
    return store.where(F.col("status").isin(*EXPORTABLE) & (F.col("sense_fit") == "mismatch") & ~F.col("decided_by").eqNullSafe(F.lit("human")))


def purge_senses(lines: DataFrame, key: str) -> dict[str, DataFrame]:
    """Sense lines (word, pos, best_sense, raw) without a key: kept lines, removed and remaining types. Unreadable lines stay."""
    hit = F.coalesce(F.col("best_sense") == key, F.lit(False))
    kept = lines.where(~hit)
    pair = ["word", "pos"]
    removed = lines.where(hit).select(*pair).distinct()
    remaining = kept.where("word IS NOT NULL").select(*pair).distinct()
    return {"kept": kept, "removed": removed, "remaining": remaining, "fully_removed": removed.join(remaining, pair, "left_anti")}


def purge_types(rows: DataFrame, gone: DataFrame, word: str = "lemma", pos: str = "wn_pos") -> DataFrame:
    """Rows of types that are gone are left out; rows that couldn't be read stay."""
    left = gone.select(F.col("word").alias(word), F.col("pos").alias(pos))
    return rows.join(left, [word, pos], "left_anti")


def adjudication_signals(entries: DataFrame, zipfs: DataFrame, least_zipf: float = 1.0) -> DataFrame:
    """resource_match, apertium_match, wordfreq_ok of entries (key, fr, fr_alt, resources, apertium)."""
    candidates = F.array_compact(F.concat(F.array("fr"), F.coalesce("fr_alt", F.array().cast("array<string>"))))
    rows = entries.withColumn("resource_match", any_match(candidates, F.col("resources"))).withColumn("apertium_match", any_match(candidates, F.col("apertium")))
    words = entries.select("key", F.explode(F.transform(readable_content_words(F.col("fr")), F.lower)).alias("word"))
    usual = words.join(zipfs, "word", "left").groupBy("key").agg(F.bool_and(F.coalesce(F.col("zipf") > least_zipf, F.lit(False))).alias("usual"))
    ok = F.when(F.col("fr").isNull(), False).otherwise(F.coalesce("usual", F.lit(True)))
    return rows.join(usual, "key", "left").withColumn("wordfreq_ok", ok).drop("usual")


def collisions(store: DataFrame, decided: tuple[str, ...] = ("validated", "auto_strong", "auto_corroborated", "auto_judged")) -> DataFrame:
    """(key, collision): another decided sense of the same part of speech with a shared lemma and the same French head."""
    rows = store.where((F.col("kind") == "synset") & F.col("fr").isNotNull()).select("key", "status", sense_pos(F.col("key")).alias("pos"), head_stem(F.col("fr")).alias("head"), F.explode("lemmas_en").alias("lemma"))
    taken = rows.where(F.col("status").isin(*decided) & F.col("head").isNotNull()).groupBy("pos", "head", "lemma")
    least = taken.agg(F.min("key").alias("first"), F.max("key").alias("last"))  # an entry that is the first itself still meets the last
    other = F.when(F.col("first") != F.col("key"), F.col("first")).when(F.col("last") != F.col("key"), F.col("last"))
    return rows.join(least, ["pos", "head", "lemma"]).withColumn("other", other).where("other IS NOT NULL").groupBy("key").agg(F.min("other").alias("collision"))


def sibling_senses(senses: DataFrame) -> DataFrame:
    """(sense_id, sibling): senses of the same part of speech that share a lemma."""
    left = senses.select("sense_id", "lemma", "pos")
    right = senses.select(F.col("sense_id").alias("sibling"), "lemma", "pos")
    return left.join(right, ["lemma", "pos"]).where("sense_id <> sibling").select("sense_id", "sibling").distinct()


def discrimination(scores: DataFrame) -> DataFrame:
    """Rank of each target's own score among its siblings' (target, candidate, score)."""
    ranked = scores.withColumn("rank", F.rank().over(W.partitionBy("target").orderBy(F.desc("score"))))
    return ranked.where("candidate = target").select("target", "rank")


def normalise_judgments(judgments: DataFrame) -> DataFrame:
    """Judgments of x and y as those of joint and current, by which came first."""
    pick = lambda a, b: F.when(F.col("first_joint"), F.col(a)).otherwise(F.col(b))
    preferred = F.when(F.col("preferred") == "tie", "tie").when((F.col("preferred") == "x") == F.col("first_joint"), "joint").otherwise("current")
    return judgments.select("case_id", pick("x", "y").alias("joint"), pick("y", "x").alias("current"), preferred.alias("preferred"))


def stable(first: DataFrame, second: DataFrame) -> DataFrame:
    """Cases whose two passes agree in all dimensions, and in preference."""
    a, b = first.alias("a"), second.alias("b")
    same = F.lit(True)
    for side in ("joint", "current"):
        for d in DIMENSIONS:
            same = same & F.col(f"a.{side}.{d}").eqNullSafe(F.col(f"b.{side}.{d}"))
    return a.join(b, F.col("a.case_id") == F.col("b.case_id")).select("a.case_id", same.alias("stable"), F.col("a.preferred").eqNullSafe(F.col("b.preferred")).alias("preference_stable"))


def benchmark_report(judged: DataFrame) -> DataFrame:
    """By stratum (all of them in the row without one): shares of joint and current, regressions, and the gates on the whole."""
    share = lambda side: F.avg(F.col(f"{side}.overall").cast("int"))
    worse = F.count_if(F.col("current.overall") & ~F.col("joint.overall"))
    unstable = F.avg((~F.col("stable")).cast("int"))
    rows = judged.rollup("stratum").agg(F.count("*").alias("n"), share("joint").alias("joint"), share("current").alias("current"), worse.alias("regressions"), unstable.alias("unstable"))
    gain = F.col("joint") - F.col("current")
    adopt = (gain >= 0.10) & (F.col("regressions") <= 2) & (F.col("unstable") < 0.10)
    return rows.withColumn("adopt", F.when(F.col("stratum").isNull(), adopt))


def quota_cases(rows: DataFrame, quotas: dict[str, int], seed: int = 42) -> DataFrame:
    """The quota of each stratum, in the order of seeded hashes; too few rows are an error."""
    quota: Column = F.lit(0)
    for name, n in quotas.items():
        quota = F.when(F.col("stratum") == name, n).otherwise(quota)
    picked = rows.withColumn("turn", F.row_number().over(W.partitionBy("stratum").orderBy(F.xxhash64("key", F.lit(seed)), "key"))).where(F.col("turn") <= quota).drop("turn")
    found = {r.stratum: r.n for r in picked.groupBy("stratum").agg(F.count("*").alias("n")).collect()}  # a row a stratum
    if short := {s: n for s, n in quotas.items() if found.get(s, 0) < n}:
        raise ValueError(f"too few cases: {short}")
    return picked
