"""The store over labels and documents: gates, upserts, locks, signals, purges, samples, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import spans, store
from lexspark.operators.maintenance import collisions
from lexspark.plans.corpus import doc_tokens
from lexspark.plans.lexicon import text_words, words_sql
from lexspark.plans.registry import WORDS_SQL, query, table


def entries(spark: SparkSession, sf: str) -> DataFrame:
    """The store: a row for each labelled document, status by its labels."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", F.concat_ws("-", "lang", "source").alias("fr"))
    status = F.when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 0, "pending").when(F.col("doc_id") % 3 == 0, "validated").when(F.col("doc_id") % 3 == 1, "auto_joint").otherwise("auto_strong")
    return table(spark, sf, "labels").join(docs, "doc_id").withColumn("status", status)


ENTRIES_SQL = """entries AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, d.lang || '-' || d.source AS fr, l.quality, l.toxic,
CASE WHEN toxic = 1 THEN 'rejected' WHEN quality = 0 THEN 'pending' WHEN d.doc_id % 3 = 0 THEN 'validated' WHEN d.doc_id % 3 = 1 THEN 'auto_joint' ELSE 'auto_strong' END AS status
FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""


@query(f"""WITH {ENTRIES_SQL} SELECT doc_id, CASE WHEN n_chars < 200 THEN 'frontier_sans_reponse' WHEN quality = 0 AND toxic = 0 AND doc_id % 2 = 0 THEN 'sense_id_suspect'
WHEN quality = 0 THEN 'sense_id_douteux' WHEN lang = 'de' THEN 'frontier_explicitation' WHEN n_chars < 700 THEN 'frontier_confiance_faible'
WHEN lang <> 'en' THEN 'frontier_sans_ressource' WHEN doc_id % 5 < 3 THEN 'frontier_concordant' ELSE 'frontier_desaccord' END AS agreement,
CASE WHEN n_chars < 200 OR quality = 0 OR lang = 'de' OR n_chars < 700 THEN 'pending' WHEN lang <> 'en' THEN 'auto_llm' WHEN doc_id % 5 < 3 THEN 'auto_strong' ELSE 'pending' END AS status FROM entries""")
def q_status_gate(spark: SparkSession, sf: str) -> DataFrame:
    fit = F.when((F.col("quality") == 0) & (F.col("toxic") == 0) & (F.col("doc_id") % 2 == 0), "mismatch").when(F.col("quality") == 0, "doubtful").otherwise("ok")
    kind = F.when(F.col("lang") == "de", "explicitation").otherwise("equivalence_directe")
    confidence = F.when(F.col("n_chars") < 700, "low").otherwise("high")
    decision = store.sense_decision(F.col("n_chars") >= 200, fit, kind, confidence, F.col("lang") == "en", F.col("doc_id") % 5 < 3)
    return entries(spark, sf).select("doc_id", decision.alias("d")).select("doc_id", "d.agreement", "d.status")


@query(f"""WITH {ENTRIES_SQL}, n AS (SELECT vec_id AS doc_id, 'auto_llm' AS status, CAST(label AS VARCHAR) AS fr FROM embeddings)
SELECT coalesce(o.doc_id, n.doc_id) AS doc_id,
  CASE WHEN n.doc_id IS NULL OR (o.doc_id IS NOT NULL AND o.status IN ('validated', 'auto_joint')) THEN o.status ELSE n.status END AS status,
  CASE WHEN n.doc_id IS NULL OR (o.doc_id IS NOT NULL AND o.status IN ('validated', 'auto_joint')) THEN o.fr ELSE n.fr END AS fr,
  CASE WHEN n.doc_id IS NULL THEN 'untouched' WHEN o.doc_id IS NULL THEN 'inserted' WHEN o.status IN ('validated', 'auto_joint') THEN 'protected' ELSE 'updated' END AS action
FROM entries o FULL JOIN n ON o.doc_id = n.doc_id""")
def q_protected_upsert(spark: SparkSession, sf: str) -> DataFrame:
    new = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit("auto_llm").alias("status"), F.col("label").cast("string").alias("fr"))
    return store.upsert(entries(spark, sf), new, "doc_id", ["status", "fr"])


@query(f"""WITH {ENTRIES_SQL}, s AS (SELECT doc_id, fr FROM entries WHERE status = 'validated'),
c AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN fr || '!' ELSE fr END AS fr FROM entries WHERE status IN ('validated', 'auto_strong') AND lang <> 'de')
SELECT coalesce(s.doc_id, c.doc_id) AS doc_id, CASE WHEN c.doc_id IS NULL THEN 'missing' WHEN s.doc_id IS NULL THEN 'new' ELSE 'changed' END AS verdict
FROM s FULL JOIN c ON s.doc_id = c.doc_id WHERE c.doc_id IS NULL OR s.doc_id IS NULL OR s.fr <> c.fr""")
def q_lock_diff(spark: SparkSession, sf: str) -> DataFrame:
    rows = entries(spark, sf)
    saved = rows.where("status = 'validated'").select("doc_id", "fr")
    fr = F.when(F.col("doc_id") % 7 == 0, F.concat("fr", F.lit("!"))).otherwise(F.col("fr"))
    current = rows.where("status IN ('validated', 'auto_strong') AND lang <> 'de'").select("doc_id", fr.alias("fr"))
    return store.lock_diff(saved, current, "doc_id", "fr")


def signals() -> Column:
    flag = lambda c: F.when(c, 1).otherwise(0)
    return flag(F.col("n_chars") > 800) + flag(F.col("lang") == "en") + flag(F.col("doc_id") % 2 == 0)


SIGNALS_SQL = "(CASE WHEN n_chars > 800 THEN 1 ELSE 0 END + CASE WHEN lang = 'en' THEN 1 ELSE 0 END + CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END)"


#: Validated entries count as decided; here the strong ones are taken as the machine's answers still to be tested.
OPEN_SQL = "CASE WHEN status = 'auto_strong' THEN 'auto_llm' ELSE status END"
A_SQL = f"""{ENTRIES_SQL}, o0 AS (SELECT *, {SIGNALS_SQL} AS n_signals, {OPEN_SQL} AS st, n_chars % 3 <> 0 AS sound FROM entries),
taken AS (SELECT lang, source, n_chars % 50 AS head, count(*) AS n FROM o0 WHERE st IN ('validated', 'auto_strong', 'auto_corroborated', 'auto_judged') AND n_chars % 50 >= 10 GROUP BY 1, 2, 3),
o AS (SELECT o0.*, coalesce(t.n, 0) > CASE WHEN st IN ('validated', 'auto_strong', 'auto_corroborated', 'auto_judged') THEN 1 ELSE 0 END AS collides FROM o0 LEFT JOIN taken t ON t.lang = o0.lang AND t.source = o0.source AND t.head = o0.n_chars % 50),
a AS (SELECT *, CASE WHEN st IN ('pending', 'auto_llm') AND n_signals >= 2 AND sound AND NOT collides THEN 'auto_corroborated' WHEN st = 'auto_llm' AND NOT (sound AND NOT collides) THEN 'pending' ELSE st END AS after_a FROM o)"""


def after_a(spark: SparkSession, sf: str) -> DataFrame:
    rows = entries(spark, sf).withColumn("st", F.when(F.col("status") == "auto_strong", "auto_llm").otherwise(F.col("status"))).withColumn("n_signals", signals())
    key = F.concat(F.lit("k"), F.col("doc_id").cast("string"), F.lit("."), "lang", F.lit(".01"))
    rows = rows.withColumn("key", key)
    word = F.concat(F.lit("w"), (F.col("n_chars") % 50).cast("string"))
    other = collisions(rows.select("key", F.lit("synset").alias("kind"), F.col("st").alias("status"), word.alias("fr"), F.array("source").alias("lemmas_en")))
    rows = rows.join(other, "key", "left")
    a = store.stage_a(F.col("n_signals"), F.col("n_chars") % 3 != 0, F.col("collision").isNotNull(), F.col("st"), F.col("fr").isNotNull())
    return rows.withColumn("after_a", a)


@query(f"WITH {A_SQL} SELECT doc_id, n_signals, after_a FROM a")
def q_signals_2_of_3(spark: SparkSession, sf: str) -> DataFrame:
    return after_a(spark, sf).select("doc_id", "n_signals", "after_a")


@query(f"""WITH {A_SQL}, b AS (SELECT *, CASE WHEN after_a IN ('pending', 'auto_llm') AND (n_signals = 1 OR (after_a = 'auto_llm' AND sound)) AND n_chars % 2 = 0 THEN 'auto_corroborated' ELSE after_a END AS after_b FROM a)
SELECT doc_id, after_b, CASE WHEN after_b NOT IN ('pending', 'auto_llm') THEN after_b WHEN lang = 'es' THEN 'no_equivalent' WHEN n_chars > 2000 THEN 'auto_judged' ELSE 'pending' END AS after_c FROM b""")
def q_stage_b_c(spark: SparkSession, sf: str) -> DataFrame:
    b = store.stage_b(F.col("n_signals"), F.col("n_chars") % 3 != 0, F.col("n_chars") % 2 == 0, F.lit(True), F.col("after_a"))
    rows = after_a(spark, sf).withColumn("after_b", b)
    verdict = F.when(F.col("lang") == "es", "no_equivalent").otherwise("kept")
    confidence = F.when(F.col("n_chars") > 2000, "high").otherwise("low")
    return rows.select("doc_id", "after_b", store.stage_c(verdict, confidence, F.col("after_b")).alias("after_c"))


STEM_SQL = "regexp_replace({}, '^(.{{3,}})[sx]$', '\\1')"


@query(f"""WITH w AS (SELECT doc_id, lang, source, regexp_extract_all(lower(text), '[a-z]{{4,}}') AS w FROM documents),
r AS (SELECT doc_id, list_transform(list_distinct(w), lambda x: {STEM_SQL.format('x')}) AS a, list_transform(regexp_extract_all(lower(lang || ' ' || source || ' document'), '[a-z]{{4,}}'), lambda x: {STEM_SQL.format('x')}) AS b, {STEM_SQL.format('w[3]')} AS v, len(w) AS n FROM w),
k AS (SELECT doc_id, n, v, CASE WHEN doc_id % 4 = 0 THEN [] ELSE a END AS a, CASE WHEN doc_id % 3 = 0 THEN [] ELSE b END AS b FROM r)
SELECT doc_id, CASE WHEN len(list_intersect(a, b)) > 0 THEN 'concordantes' WHEN len(a) > 0 AND len(b) > 0 THEN 'divergentes' WHEN len(a) > 0 OR len(b) > 0 THEN 'source_unique' ELSE 'aucune_source' END AS agreement,
  CASE WHEN len(list_intersect(a, b)) > 0 THEN 'auto_strong' WHEN len(a) > 0 AND len(b) > 0 THEN 'pending' WHEN (len(a) > 0 OR len(b) > 0) AND coalesce(list_contains(CASE WHEN len(a) > 0 THEN a ELSE b END, v), false) AND n % 2 = 0 THEN 'auto_strong' ELSE 'pending' END AS status FROM k""")
def q_resource_agreement(spark: SparkSession, sf: str) -> DataFrame:
    four = lambda c: F.regexp_extract_all(F.lower(c), F.lit("[a-z]{4,}"), F.lit(0))
    rows = table(spark, sf, "documents").select("doc_id", four(F.col("text")).alias("w"), four(F.concat_ws(" ", "lang", "source", F.lit("document"))).alias("other"))
    none = F.array().cast("array<string>")
    omw = F.when(F.col("doc_id") % 4 == 0, none).otherwise(F.array_distinct("w"))
    wonef = F.when(F.col("doc_id") % 3 == 0, none).otherwise(F.col("other"))
    d = store.resource_decision(omw, wonef, T.fr_stem(F.get("w", F.lit(2))), F.size("w") % 2 == 0)
    return rows.select("doc_id", d.alias("d")).select("doc_id", "d.agreement", "d.status")


HEAD_SQL = "heads AS (SELECT doc_id, lang, regexp_extract(lower(text), '[a-z]{4,}') AS head FROM documents)"


def heads(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "lang", F.regexp_extract(F.lower("text"), "[a-z]{4,}", 0).alias("head"))


@query(f"WITH {HEAD_SQL}, f AS (SELECT lang, head, min(doc_id) AS first_id, count(*) AS n FROM heads GROUP BY lang, head) SELECT h.doc_id, f.first_id AS other FROM heads h JOIN f ON h.lang = f.lang AND h.head = f.head WHERE f.n > 1 AND f.first_id < h.doc_id")
def q_collision(spark: SparkSession, sf: str) -> DataFrame:
    """The first other entry with the same head, by aggregation instead of a self-join on frequent heads."""
    rows = heads(spark, sf)
    first = rows.groupBy("lang", "head").agg(F.min("doc_id").alias("other"), F.count("*").alias("n")).where("n > 1")
    return rows.join(first, ["lang", "head"]).where("other < doc_id").select("doc_id", "other")


@query("""WITH e AS (SELECT DISTINCT c_nationkey AS a, s_nationkey AS b FROM customer JOIN supplier ON c_nationkey % 5 = s_nationkey % 5 AND c_custkey % 50 = s_suppkey % 50),
t AS (SELECT a, b FROM e UNION SELECT x.a, y.b FROM e x JOIN e y ON x.b = y.a)
SELECT n_nationkey, n_name FROM nation WHERE EXISTS (SELECT 1 FROM t WHERE t.a = n_nationkey AND t.b IN (0, 1, 2))""")
def q_neighbour_semi(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("a"), (F.col("c_nationkey") % 5).alias("m"), (F.col("c_custkey") % 50).alias("k")).distinct()
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("b"), (F.col("s_nationkey") % 5).alias("m"), (F.col("s_suppkey") % 50).alias("k")).distinct()
    one = c.join(s, ["m", "k"]).select("a", "b").distinct()
    two = one.join(one.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b"))
    near = one.union(two).where("b IN (0, 1, 2)").select(F.col("a").alias("n_nationkey")).distinct()
    return table(spark, sf, "nation").join(near, "n_nationkey", "left_semi").select("n_nationkey", "n_name")


@query("""WITH c AS (SELECT doc_id, 'k' || (doc_id + 1) AS new_key, CASE WHEN lang = 'fr' THEN 'v' END AS new_pos FROM documents WHERE source = 'src1')
SELECT d.doc_id, coalesce(c.new_key, 'k' || d.doc_id) AS key, CASE WHEN c.doc_id IS NOT NULL THEN coalesce(c.new_pos, 'none') ELSE d.lang END AS pos, c.doc_id IS NOT NULL AS corrected FROM documents d LEFT JOIN c ON c.doc_id = d.doc_id""")
def q_manual_correction(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    key = lambda c: F.concat(F.lit("k"), c.cast("string"))
    fixes = docs.where("source = 'src1'").select("doc_id", key(F.col("doc_id") + 1).alias("new_key"), F.when(F.col("lang") == "fr", "v").alias("new_pos"))
    hit = F.col("new_key").isNotNull()
    pos = F.when(hit, F.coalesce("new_pos", F.lit("none"))).otherwise(F.col("lang"))
    return docs.join(fixes, "doc_id", "left").select("doc_id", F.coalesce("new_key", key(F.col("doc_id"))).alias("key"), pos.alias("pos"), hit.alias("corrected"))


@query(f"""WITH {WORDS_SQL}, removed AS (SELECT DISTINCT word, lang FROM tok WHERE source = 'src3'), remaining AS (SELECT DISTINCT word, lang FROM tok WHERE source <> 'src3')
SELECT word, lang FROM removed EXCEPT SELECT word, lang FROM remaining""")
def q_purge_cascade(spark: SparkSession, sf: str) -> DataFrame:
    rows = doc_tokens(spark, sf).select("word", "lang", "source")
    return store.fully_removed(rows.where("source = 'src3'"), rows.where("source <> 'src3'").select("word", "lang").distinct(), ["word", "lang"])


@query(f"""WITH {WORDS_SQL} SELECT 'documents' AS part, count(*) AS n FROM documents WHERE source = 'src3' UNION ALL SELECT 'tokens', count(*) FROM tok WHERE source = 'src3'
UNION ALL SELECT 'labels', count(*) FROM labels l WHERE EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id AND d.source = 'src3')""")
def q_purge_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where("source = 'src3'")
    n = F.count("*").alias("n")
    counts = docs.agg(n).select(F.lit("documents").alias("part"), "n")
    words = docs.agg(F.coalesce(F.sum(F.size(T.words(F.col("text")))), F.lit(0)).alias("n")).select(F.lit("tokens").alias("part"), "n")
    labels = table(spark, sf, "labels").join(docs.select("doc_id"), "doc_id", "left_semi").agg(n).select(F.lit("labels").alias("part"), "n")
    return counts.unionByName(words).unionByName(labels)


AGREE_SQL = "CASE source WHEN 'src0' THEN 'aucune_source' WHEN 'src1' THEN 'source_unique' ELSE 'divergentes' END"


@query(f"WITH {ENTRIES_SQL} SELECT doc_id AS key, {AGREE_SQL} AS agreement, n_chars AS occurrences FROM entries WHERE status = 'pending' ORDER BY CASE source WHEN 'src0' THEN 0 WHEN 'src1' THEN 2 ELSE 1 END, n_chars DESC, doc_id LIMIT 200")
def q_review_queue(spark: SparkSession, sf: str) -> DataFrame:
    agreement = F.when(F.col("source") == "src0", "aucune_source").when(F.col("source") == "src1", "source_unique").otherwise("divergentes")
    rows = entries(spark, sf).select(F.col("doc_id").alias("key"), "status", agreement.alias("agreement"), F.col("n_chars").alias("occurrences"))
    return store.review_order(rows).limit(200).drop("status")


@query(f"WITH {ENTRIES_SQL} SELECT doc_id FROM entries WHERE status = 'pending' AND source IN ('src1', 'src2', 'src3', 'src4') AND doc_id NOT IN (SELECT doc_id FROM entries WHERE n_chars < 500)")
def q_structural_pending(spark: SparkSession, sf: str) -> DataFrame:
    rows = entries(spark, sf)
    return rows.where("status = 'pending' AND source IN ('src1', 'src2', 'src3', 'src4')").join(rows.where("n_chars < 500").select("doc_id"), "doc_id", "left_anti").select("doc_id")


@query(f"""WITH {ENTRIES_SQL} SELECT d.doc_id, CASE WHEN contains(d.text, ' ') THEN 'mwe' ELSE 'word' END AS unit_type,
coalesce(e.status, 'absent') AS fr_status, CASE WHEN e.status IN ('validated', 'auto_strong', 'auto_joint') THEN e.fr ELSE '' END AS official FROM documents d LEFT JOIN entries e ON e.doc_id = d.doc_id""")
def q_official_translation(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.contains("text", F.lit(" ")), "mwe").otherwise("word").alias("unit_type"))
    found = entries(spark, sf).select("doc_id", "status", "fr")
    official = F.when(F.col("status").isin(*store.EXPORTABLE), F.col("fr")).otherwise("")
    return docs.join(found, "doc_id", "left").select("doc_id", "unit_type", F.coalesce("status", F.lit("absent")).alias("fr_status"), official.alias("official"))


@query("""SELECT CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'invented' END AS problem, coalesce(d.doc_id, l.doc_id) AS doc_id
FROM (SELECT vec_id AS doc_id FROM embeddings) d FULL JOIN (SELECT doc_id FROM labels) l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL""")
def q_missing_or_invented(spark: SparkSession, sf: str) -> DataFrame:
    asked = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"))
    answered = table(spark, sf, "labels").select("doc_id")
    missing = asked.join(answered, "doc_id", "left_anti").select(F.lit("missing").alias("problem"), "doc_id")
    return missing.unionByName(answered.join(asked, "doc_id", "left_anti").select(F.lit("invented").alias("problem"), "doc_id"))


@query("""WITH m AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS turn FROM documents) SELECT * FROM m ORDER BY turn, source LIMIT 150""")
def q_round_robin_sample(spark: SparkSession, sf: str) -> DataFrame:
    return store.round_robin(table(spark, sf, "documents").select("doc_id", "source"), "source", ["doc_id"], 150)


@query("""WITH m AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR))) AS turn FROM documents) SELECT * FROM m WHERE turn <= 25""")
def q_quota_sample(spark: SparkSession, sf: str) -> DataFrame:
    return store.quota(table(spark, sf, "documents").select("doc_id", "lang"), "lang", [F.md5(F.col("doc_id").cast("string"))], 25)


@query(f"""WITH v AS (SELECT word, left(word, 3) AS vote, 1 AS k FROM {words_sql('documents')} UNION ALL SELECT word, left(word, 3) AS vote, 2 FROM {words_sql('benchmark')} UNION ALL SELECT word, left(word, 4), 3 FROM {words_sql('conversations')}),
c AS (SELECT word, vote, count(*) AS n, min(k) AS first FROM v GROUP BY word, vote), r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, first, vote) AS k FROM c)
SELECT word, vote, n FROM r WHERE k = 1 AND n >= 2""")
def q_votes(spark: SparkSession, sf: str) -> DataFrame:
    votes = None
    for k, (name, cut) in enumerate((("documents", 3), ("benchmark", 3), ("conversations", 4)), 1):
        own = text_words(spark, sf, name).select("word", F.substring("word", 1, cut).alias("vote"), F.lit(k).alias("k"))
        votes = own if votes is None else votes.unionByName(own)
    return store.consensus(votes, ["word"], "vote", "k")


@query("""WITH s AS (SELECT count(*) AS n, count(*) FILTER (WHERE quality = 1) AS joint_ok, count(*) FILTER (WHERE toxic = 0) AS now_ok, count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS regressions FROM labels)
SELECT n, round(100.0 * joint_ok / n, 6) AS joint_percent, round(100.0 * now_ok / n, 6) AS now_percent, regressions, joint_ok - now_ok >= 0.10 * n AS gate_overall, regressions <= 2 AS gate_regressions FROM s""")
def q_agreement_gates(spark: SparkSession, sf: str) -> DataFrame:
    q, t = F.col("quality"), F.col("toxic")
    s = table(spark, sf, "labels").agg(F.count("*").alias("n"), F.count_if(q == 1).alias("j"), F.count_if(t == 0).alias("w"), F.count_if((q == 0) & (t == 0)).alias("regressions"))
    percent = lambda c: F.round(F.try_divide(100.0 * F.col(c), F.col("n")), 6)
    return s.select("n", percent("j").alias("joint_percent"), percent("w").alias("now_percent"), "regressions", (F.col("j") - F.col("w") >= 0.10 * F.col("n")).alias("gate_overall"), (F.col("regressions") <= 2).alias("gate_regressions"))


@query("""WITH a AS (SELECT doc_id, quality AS x, toxic AS y FROM labels), b AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 1 - quality ELSE quality END AS x, toxic AS y FROM labels)
SELECT a.doc_id, a.x = b.x AND a.y = b.y AS stable FROM a JOIN b ON a.doc_id = b.doc_id""")
def q_stable_two_pass(spark: SparkSession, sf: str) -> DataFrame:
    first = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    second = first.select("doc_id", F.when(F.col("doc_id") % 9 == 0, 1 - F.col("quality")).otherwise(F.col("quality")).alias("q2"), F.col("toxic").alias("t2"))
    return first.join(second, "doc_id").select("doc_id", ((F.col("quality") == F.col("q2")) & (F.col("toxic") == F.col("t2"))).alias("stable"))


@query(f"""WITH {ENTRIES_SQL}, p AS (SELECT doc_id, doc_id + 3 AS target, CASE WHEN doc_id % 4 = 0 THEN doc_id WHEN lang = 'de' THEN NULL ELSE doc_id + 3 END AS proposed FROM entries WHERE status = 'pending')
SELECT p.doc_id, CASE WHEN p.proposed IS NULL THEN 'audit' WHEN p.proposed = p.doc_id THEN 'promu' WHEN t.status IN ('validated', 'auto_joint', 'auto_strong') THEN 'bloque' ELSE 'reassigne' END AS outcome
FROM p LEFT JOIN entries t ON t.doc_id = p.proposed""")
def q_reassign(spark: SparkSession, sf: str) -> DataFrame:
    rows = entries(spark, sf)
    proposed = F.when(F.col("doc_id") % 4 == 0, F.col("doc_id")).when(F.col("lang") != "de", F.col("doc_id") + 3)
    asked = rows.where("status = 'pending'").select("doc_id", proposed.alias("proposed"))
    target = rows.select(F.col("doc_id").alias("proposed"), F.col("status").alias("target_status"))
    outcome = store.first_match((F.col("proposed").isNull(), "audit"), (F.col("proposed") == F.col("doc_id"), "promu"), (F.coalesce(F.col("target_status").isin(*store.EXPORTABLE), F.lit(False)), "bloque"), otherwise="reassigne")
    return asked.join(target, "proposed", "left").select("doc_id", outcome.alias("outcome"))


@query(f"""WITH {ENTRIES_SQL}, dec AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'no' WHEN 2 THEN 'none' ELSE 'later' END AS decision FROM documents)
SELECT dec.doc_id, CASE WHEN e.doc_id IS NULL THEN 'error: unknown key' WHEN decision = 'later' THEN 'error: unknown decision' WHEN decision = 'ok' THEN 'validated' WHEN decision = 'no' THEN 'rejected' ELSE 'no_equivalent' END AS result
FROM dec LEFT JOIN entries e ON e.doc_id = dec.doc_id""")
def q_commit(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*map(F.lit, ("ok", "no", "none", "later")))
    asked = table(spark, sf, "documents").select("doc_id", F.element_at(names, (F.col("doc_id") % 4 + 1).cast("int")).alias("decision"))
    known = entries(spark, sf).select("doc_id", "status")
    result = store.first_match((F.col("status").isNull(), "error: unknown key"), (F.col("decision") == "later", "error: unknown decision"), (F.col("decision") == "ok", "validated"), (F.col("decision") == "no", "rejected"), otherwise="no_equivalent")
    return asked.join(known, "doc_id", "left").select("doc_id", result.alias("result"))


@query("""SELECT item_id, CASE item_id % 6 WHEN 0 THEN 'idiome' WHEN 1 THEN 'phrasal_verb' WHEN 2 THEN 'semi_fige' WHEN 3 THEN 'littéral' ELSE 'incertain' END AS label,
CASE WHEN item_id % 6 = 5 THEN 0.0 ELSE (item_id % 10) / 10 END AS confidence FROM benchmark""")
def q_checked_labels(spark: SparkSession, sf: str) -> DataFrame:
    given = F.element_at(F.array(*map(F.lit, ("idiome", "phrasal_verb", "semi_fige", "littéral", "incertain", "?"))), (F.col("item_id") % 6 + 1).cast("int"))
    checked = spans.checked_label(given, F.col("item_id") % 10 / 10)
    return table(spark, sf, "benchmark").select("item_id", checked.alias("c")).select("item_id", "c.label", "c.confidence")


@query(f"""WITH {HEAD_SQL}, b AS (SELECT DISTINCT regexp_extract(lower(text), '[a-z]{{4,}}') AS head FROM benchmark), c AS {words_sql('conversations')}
SELECT h.doc_id, EXISTS (SELECT 1 FROM b WHERE b.head = h.head) AS resource_match, EXISTS (SELECT 1 FROM c WHERE c.word = h.head) AS apertium_match FROM heads h""")
def q_signals(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "benchmark").select(F.regexp_extract(F.lower("text"), "[a-z]{4,}", 0).alias("head")).distinct().withColumn("r", F.lit(True))
    attested = text_words(spark, sf, "conversations").select(F.col("word").alias("head"), F.lit(True).alias("a"))
    rows = heads(spark, sf).join(known, "head", "left").join(attested, "head", "left")
    return rows.select("doc_id", F.coalesce("r", F.lit(False)).alias("resource_match"), F.coalesce("a", F.lit(False)).alias("apertium_match"))
