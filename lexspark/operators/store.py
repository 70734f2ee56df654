"""The decision store: gates, guarded upserts, locks, corrections, purges, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexspark.checkpoints import checkpointed
from lexspark.functions.text import fr_stem

#: States that no automatic step may change, and those that are exported.
PROTECTED = ("validated", "auto_joint")
EXPORTABLE = ("validated", "auto_strong", "auto_llm", "auto_corroborated", "auto_judged", "auto_joint")


#: Agreements by urgency of review; others come with the middle ones.
AGREEMENT_RANK = {"sense_id_non_resolu": 0, "aucune_source": 0, "mwe_sans_ressource": 0, "divergentes": 1, "source_unique": 2}


def agreement_rank(agreement: Column) -> Column:
    rank = F.lit(1)
    for name, r in AGREEMENT_RANK.items():
        rank = F.when(agreement == name, r).otherwise(rank)
    return rank


def review_order(store: DataFrame) -> DataFrame:
    """Pending entries, the most urgent first, frequent ones first among these."""
    return store.where("status = 'pending'").orderBy(agreement_rank(F.col("agreement")), F.desc("occurrences"), "key")


def is_protected(status: Column) -> Column:
    return F.coalesce(status.isin(*PROTECTED), F.lit(False))


def first_match(*gates: tuple[Column, str], otherwise: str | None = None) -> Column:
    """The name of the first gate that holds."""
    out = None
    for condition, name in gates:
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return out if otherwise is None else out.otherwise(otherwise)


def upsert(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of both, new ones first, but protected old ones unchanged; one full outer join."""
    o = old.select(F.col(key), *[F.col(c).alias(f"o_{c}") for c in columns], F.lit(True).alias("o_"))
    n = new.select(F.col(key), *[F.col(c).alias(f"n_{c}") for c in columns], F.lit(True).alias("n_"))
    stays = F.col("n_").isNull() | (F.col("o_").isNotNull() & is_protected(F.col("o_status")))
    action = F.when(F.col("n_").isNull(), "untouched").when(F.col("o_").isNull(), "inserted").when(is_protected(F.col("o_status")), "protected").otherwise("updated")
    chosen = [F.when(stays, F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c) for c in columns]
    return o.join(n, key, "full_outer").select(key, *chosen, action.alias("action"))


def lock_diff(saved: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """(key, verdict): missing, changed or new; equal rows are left out."""
    s = saved.select(key, F.col(value).alias("s"), F.lit(1).alias("in_s"))
    c = current.select(key, F.col(value).alias("c"), F.lit(1).alias("in_c"))
    verdict = F.when(F.col("in_c").isNull(), "missing").when(F.col("in_s").isNull(), "new").when(~F.col("s").eqNullSafe(F.col("c")), "changed")
    return s.join(c, key, "full_outer").select(key, verdict.alias("verdict")).where("verdict IS NOT NULL")


def replace_by_key(rows: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(more, keys, "left_anti").unionByName(more.select(*rows.columns))


def fully_removed(removed: DataFrame, remaining: DataFrame, keys: list[str]) -> DataFrame:
    """Types that lost a sense and have none left."""
    return removed.select(*keys).distinct().join(remaining, keys, "left_anti")


def round_robin(rows: DataFrame, stratum: str, order: list[str], n: int) -> DataFrame:
    """n rows, taken in turn from the strata."""
    return first_of_each(rows, stratum, order, n).orderBy("turn", stratum).limit(n)


def first_of_each(rows: DataFrame, stratum: str, order: list, n: int, spread: int = 64) -> DataFrame:
    """The first n rows of each stratum, numbered (turn): taken in `spread` parts of a stratum first, so that a frequent one is no single task."""
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(spread)).alias("__part")
    near = rows.select("*", part).withColumn("turn", F.row_number().over(W.partitionBy(stratum, "__part").orderBy(*order))).where(F.col("turn") <= n)
    return near.drop("__part", "turn").withColumn("turn", F.row_number().over(W.partitionBy(stratum).orderBy(*order))).where(F.col("turn") <= n)


def quota(rows: DataFrame, stratum: str, order: list, n: int) -> DataFrame:
    """The first n rows of each stratum."""
    return first_of_each(rows, stratum, order, n)


def batches(rows: DataFrame, kind: str, order: str, size: int) -> DataFrame:
    """Batch numbers within each kind, in order. Ranks are taken inside ranges of (kind, order) and then offset by the
    counts of the ranges before, so that no kind is a single task."""
    placed = checkpointed(rows.repartitionByRange(kind, order).withColumn("__part", F.spark_partition_id()))  # ranges must be those of the counts
    counts = placed.groupBy(kind, "__part").agg(F.count("*").alias("__own"))
    before = counts.withColumn("__before", F.sum("__own").over(W.partitionBy(kind).orderBy("__part")) - F.col("__own")).drop("__own")  # a row a range
    inside = F.row_number().over(W.partitionBy(kind, "__part").orderBy(order)) - 1
    ranked = placed.withColumn("__inside", inside).join(before, [kind, "__part"])
    return ranked.withColumn("batch", F.floor((F.col("__before") + F.col("__inside")) / size)).select(*rows.columns, "batch")


def stage_a(n_signals: Column, wordfreq_ok: Column, collision: Column, status: Column, has_fr: Column) -> Column:
    """Two of three signals, usual words and no collision corroborate; a doubtful machine answer goes back; decided entries stay."""
    sound = wordfreq_ok & ~collision
    open_ = status.isin("pending", "auto_llm") & has_fr
    return F.when(open_ & (n_signals >= 2) & sound, "auto_corroborated").when(open_ & (status == "auto_llm") & ~sound, "pending").otherwise(status)


def stage_b(n_signals: Column, sound: Column, back_ok: Column, has_definition: Column, status: Column) -> Column:
    """Of entries left open with a definition: one signal, or a sound machine answer, and a back-translation that returns."""
    asked = status.isin("pending", "auto_llm") & has_definition & ((n_signals == 1) | ((status == "auto_llm") & sound))
    return F.when(asked & back_ok, "auto_corroborated").otherwise(status)


def stage_c(verdict: Column, confidence: Column, status: Column) -> Column:
    """The judge on entries left open; no verdict leaves them."""
    left = status.isin("pending", "auto_llm") & verdict.isNotNull()
    return F.when(left & (verdict == "no_equivalent"), "no_equivalent").when(left & (confidence == "high"), "auto_judged").when(left, "pending").otherwise(status)


def sense_decision(has_answer: Column, fit: Column, kind: Column, confidence: Column, has_resource: Column, overlap: Column) -> Column:
    """(status, agreement) after an answer: faithfulness to the sense first, then confidence, then the resources."""
    to = lambda status, agreement: F.struct(F.lit(status).alias("status"), (agreement if isinstance(agreement, Column) else F.lit(agreement)).alias("agreement"))
    return (
        F.when(~has_answer, to("pending", "frontier_sans_reponse"))
        .when(fit == "mismatch", to("pending", "sense_id_suspect"))
        .when(fit == "doubtful", to("pending", "sense_id_douteux"))
        .when(kind != "equivalence_directe", to("pending", F.concat(F.lit("frontier_"), kind)))
        .when(confidence == "low", to("pending", "frontier_confiance_faible"))
        .when(~has_resource, to("auto_llm", "frontier_sans_ressource"))
        .when(overlap, to("auto_strong", "frontier_concordant"))
        .otherwise(to("pending", "frontier_desaccord"))
    )


def resource_decision(omw: Column, wonef: Column, consensus_stem: Column, back_ok: Column) -> Column:
    """(status, agreement) of a sense by two resources' French words.

    Shared stems decide. Two resources that differ never do. A single one does if the votes' consensus is one
    of its words and the back-translation returns to the sense.
    """
    a, b = F.transform(omw, fr_stem), F.transform(wonef, fr_stem)
    to = lambda status, agreement: F.struct(F.lit(status).alias("status"), F.lit(agreement).alias("agreement"))
    single = F.when(F.size(a) > 0, a).otherwise(b)
    confirmed = F.coalesce(F.array_contains(single, consensus_stem), F.lit(False)) & F.coalesce(back_ok, F.lit(False))
    return (
        F.when(F.arrays_overlap(a, b), to("auto_strong", "concordantes"))
        .when((F.size(a) > 0) & (F.size(b) > 0), to("pending", "divergentes"))
        .when((F.size(a) > 0) | (F.size(b) > 0), F.when(confirmed, to("auto_strong", "source_unique")).otherwise(to("pending", "source_unique")))
        .otherwise(to("pending", "aucune_source"))
    )


def lock(entries: DataFrame) -> DataFrame:
    """(key, fr) of the entries whose translation must not change by itself."""
    return entries.where(F.col("status").isin(*EXPORTABLE) & (F.coalesce("fr", F.lit("")) != "")).select("key", "fr")


def consensus(votes: DataFrame, keys: list[str], vote: str, order: str, least: int = 2) -> DataFrame:
    """The vote given most often, at least `least` times; of equals the first seen."""
    counted = votes.groupBy(*keys, vote).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = counted.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("n"), "first", vote)).alias("b"))
    return best.select(*keys, F.col(f"b.{vote}").alias(vote), (-F.col("b.n")).alias("n")).where(F.col("n") >= least)
