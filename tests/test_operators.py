"""Operators on the fixture cases, and against small Python models."""

import difflib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexspark.functions import scores as SC
from lexspark.functions import text as T
from lexspark.functions.french import stem
from lexspark.functions.kernels import french_stem, locate_word, ratio, token_offsets
from lexspark.operators import maintenance as M
from lexspark.operators import select, senses, spans, store
from lexspark.operators import tokens as tok


def one(spark, column, **values):
    ddl = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'int'}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], ddl).select(column.alias("r")).first().r


def test_text(spark):
    c = F.col("c")
    cases = [
        (T.fold(c), "GROSSE Straße", "grosse strasse"), (T.fr_stem(c), "Élèves", "eleve"), (T.fr_stem(c), "Eux", "eux"), (T.fr_stem(c), "bois", "boi"), (T.normalize_phrase(c), " Peut-Être, l'Été! ", "peut etre l'ete"),
        (T.apostrophe_words(c), "He's don't co-op O'Neill's", ["He's", "don't", "co", "op", "O'Neill", "s"]), (T.back_translation_key(c), "To give up.", "give up"), (T.sense_pos(c), "a.b.v.02", "v"),
        (T.dictionary_id(c), "omw-en-00001740-n", "eng-30-00001740-n"), (T.dictionary_id(c), "omw-en-x-n", None), (T.parse_alternatives(c), "a; b ;;", ["a", "b"]), (T.base_forms(c), "cries", ["cries", "cry", "cri", "crie"]),
        (T.expression_key(c, F.lit("idiome")), " Give-up  Now ", "mwe:give up now:idiome"), (T.expression_key(c, F.lit("x")), " ", None), (T.head_stem(c), "le grand chien", "grand"), (T.looks_inflected(c), "running", True),
    ]
    for column, value, expected in cases:
        assert one(spark, column, c=value) == expected, value
    assert tuple(one(spark, T.split_gloss(c), c="parler (à qqn)")) == ("parler", None)
    assert tuple(one(spark, T.split_gloss(c), c="chien (animal) noir")) == ("chien noir", "animal")
    assert one(spark, T.clean_candidates(F.col("v"), F.lit("Dog")), v=[" chien ", "_EMPTY_", "dog", "chien", "", "cabot"]) == ["chien", "cabot"]
    assert one(spark, T.candidates_match(F.lit("un chien"), F.lit("chiens"))) and not one(spark, T.candidates_match(F.lit("chien"), F.lit("chat")))
    assert one(spark, T.jaccard(F.col("a"), F.col("b")), a=["x", "y"], b=["y", "z"]) == pytest.approx(1 / 3)
    assert one(spark, T.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>"))) == 0.0
    assert one(spark, T.detokenize(F.col("v")), v=["Hello", ",", "(", "you", ")", "!"]) == "Hello, (you)!"
    assert one(spark, T.match_key(F.lit("peut-être"), F.array(), F.lit("il peut etre la"))) == "peut etre"


def test_scores(spark):
    v = F.col("v")
    assert one(spark, SC.zipf_need(v), v=4.0) == 0.5
    assert one(spark, SC.zipf_need(F.lit(None).cast("double"))) == 0.5
    assert one(spark, SC.book_gain(v), v=19) == pytest.approx(0.983, abs=1e-3)
    assert one(spark, SC.clip01(v), v=7.0) == 1.0
    assert one(spark, SC.sense_surprise(F.lit(3), F.lit(0))) == 0.5
    assert one(spark, SC.aoa_component(SC.aoa_residual(F.lit(12.0), F.lit(4.0)))) == 0.0


def test_kernels(spark):
    for a, b in (("colour", "couleur"), ("table", "table"), ("", "")):
        assert one(spark, ratio(F.col("a"), F.col("b")), a=a, b=b) == difflib.SequenceMatcher(None, a, b).ratio()
    for word, expected in {"continuellement": "continuel", "maisons": "maison", "chevaux": "cheval", "mangerons": "mang", "heureuse": "heureux", "nationalité": "national", "finissant": "fin"}.items():
        assert stem(word) == expected, word
    assert one(spark, french_stem(F.col("w")), w="maisons") == "maison"
    assert [(t.surface, t.start, t.end) for t in one(spark, token_offsets(F.col("t")), t="l'eau, peut-être")] == [("l'eau", 0, 5), (",", 5, 6), ("peut-être", 7, 16)]
    got = one(spark, locate_word(F.lit("He ran. They RUNNING run"), F.col("f"), F.lit(0), F.lit(100)), f=["run", "running"])
    assert tuple(got) == (13, 20, "RUNNING")


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 5)), max_size=8))
def test_greedy(spark, raw):
    items = sorted({(s, s + n, f"l{s}-{n}") for s, n in raw}, key=lambda x: (x[0] - x[1], x[0], x[1], x[2]))
    kept = []
    for s in items:
        if not any(k[0] < s[1] and s[0] < k[1] for k in kept):
            kept.append(s)
    df = spark.createDataFrame([(1, *x) for x in items], "g int, start int, end int, label string")
    assert sorted((r.start, r.end, r.label) for r in spans.select_spans(df, ["g"]).collect()) == sorted(kept)


def test_get_away_with_and_isolated_words(spark):
    found = spark.createDataFrame([(1, 2, 4, "get away"), (1, 2, 5, "get away with"), (1, 5, 6, "it")], "seg int, start int, end int, label string")
    chosen = spans.select_spans(found, ["seg"])
    assert sorted(r.label for r in chosen.collect()) == ["get away with", "it"]
    words = spark.createDataFrame([(1, 2, "get"), (1, 4, "with"), (1, 9, "get"), (2, 2, "get")], "seg int, pos int, word string")
    assert sorted((r.seg, r.pos) for r in spans.uncovered(words, chosen, "seg").collect()) == [(1, 9), (2, 2)]
    decided = spark.createDataFrame([("idiome", 0.49), ("idiome", 0.5), ("littéral", 0.9)], "label string, confidence double")
    assert spans.lexicalised(decided).count() == 1


def test_slop(spark):
    text = spark.createDataFrame([(1, "crack the window open"), (2, "crack open"), (3, "crack the very old window open")], "id int, t string")
    rows = text.select("id", T.words(F.col("t")).alias("w"))
    assert sorted(r.id for r in tok.gapped(rows, "id", "w", "crack", "open", 2).collect()) == [1, 2]
    assert sorted(r.id for r in tok.gapped(rows, "id", "w", "crack", "open", 1).collect()) == [2]


def test_levels_and_gate(spark):
    assert one(spark, select.excluded_by_level(F.col("l")), l=["A1", "A2"]) is True
    for levels in (["A1", "B1"], ["??"], []):
        assert one(spark, select.excluded_by_level(F.col("l").cast("array<string>")), l=levels) is False
    assert one(spark, select.drop_reason(F.lit(0.5), F.lit(49), F.lit(False), F.array(F.lit("C1")))) is None
    assert one(spark, select.drop_reason(F.lit(0.5), F.lit(50), F.lit(True), F.array(F.lit("A1")))) == "pknown"


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(1, 12), st.integers(1, 5))
def test_diverse(spark, n, k):
    df = spark.createDataFrame([("a", i) for i in range(n)], "key string, at int")
    assert sorted(r["at"] for r in senses.diverse(df, ["key"], ["at"], k).collect()) == sorted({i * n // k for i in range(k)})


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 6), min_size=1, max_size=4), st.integers(1, 10))
def test_round_robin(spark, sizes, n):
    rows = [(f"s{s}", i) for s, size in enumerate(sizes) for i in range(size)]
    df = spark.createDataFrame(rows, "stratum string, i int")
    expected = sorted(rows, key=lambda r: (r[1], r[0]))[:n]
    assert sorted((r.stratum, r.i) for r in store.round_robin(df, "stratum", ["i"], n).collect()) == sorted(expected)


# ---- purge, reassignment and judgment fixtures


def sense_lines(spark, *rows):
    return spark.createDataFrame(list(rows), "word string, pos string, best_sense string, raw string")


def test_purge(spark):
    york = [("york", "n", "york.n.01", "L1"), ("york", "n", "york.n.01", "L2"), ("queens", "n", "queens.n.01", "L3")]
    out = {k: sorted(tuple(r) for r in v.collect()) for k, v in M.purge_senses(sense_lines(spark, *york), "york.n.01").items()}
    assert [r[3] for r in out["kept"]] == ["L3"] and out["removed"] == [("york", "n")] and out["remaining"] == [("queens", "n")]
    got = M.purge_senses(sense_lines(spark, (None, None, None, "{corrupted"), ("york", "n", "york.n.01", "L2")), "york.n.01")
    assert [r.raw for r in got["kept"].collect()] == ["{corrupted"] and got["remaining"].count() == 0
    got = M.purge_senses(sense_lines(spark, ("york", "n", "york.n.01", "L1"), ("york", "n", "aucun_sens_adapte", "L2")), "york.n.01")
    assert got["fully_removed"].count() == 0
    types = spark.createDataFrame([("york", "n"), ("york", "v"), (None, None)], "lemma string, wn_pos string")
    gone = spark.createDataFrame([("york", "n")], "word string, pos string")
    assert M.purge_types(types, gone).count() == 2


STORE = "key string, kind string, pos string, lemmas_en array<string>, occurrences int, status string, agreement string, fr string"


def test_reassign(spark):
    entries = spark.createDataFrame(
        [
            ("mwe:give out:phrasal_verb", "mwe", None, ["give out"], 2, "pending", "x", None), ("beat.n.08", "synset", "n", ["beat"], 30, "pending", "x", None), ("hang.v.01", "synset", "v", ["hang"], 4, "pending", "x", None),
            ("subatomic.s.01", "synset", "s", ["subatomic"], 1, "pending", "x", None), ("beat.v.04", "synset", "v", ["beat"], 5, "pending", "x", None), ("null.v.01", "synset", "v", ["null"], 1, "pending", "x", None),
            ("lock.v.01", "synset", "v", ["lock"], 3, "pending", "x", None), ("shut.v.01", "synset", "v", ["shut"], 7, "validated", "ok", "fermer"),
        ],
        STORE,
    )
    inventory = spark.createDataFrame([(s,) for s in ("cling.v.03", "subatomic.a.01", "beat.n.08", "shut.v.01", "beat.v.08")], "sense_id string")
    decisions = spark.createDataFrame(
        [
            ("mwe:give out:phrasal_verb", "fail.v.04", "tomber en panne"), ("beat.n.08", "beat.n.08", "rythme"), ("hang.v.01", "cling.v.03", "se cramponner"), ("subatomic.s.01", "subatomic.a.01", "subatomique"),
            ("beat.v.04", "beat.n.08", "x"), ("null.v.01", "beat.n.99", "x"), ("lock.v.01", "shut.v.01", "verrouiller"),
        ],
        "key string, sense_id string, fr string",
    )
    classified = M.classify_decisions(decisions, entries, inventory)
    got = {r.key: (r.outcome, r.sense_id) for r in classified.collect()}
    assert {k: v[0] for k, v in got.items()} == {
        "mwe:give out:phrasal_verb": "promu", "beat.n.08": "promu", "hang.v.01": "reassigne", "subatomic.s.01": "reassigne", "beat.v.04": "audit", "null.v.01": "audit", "lock.v.01": "bloque",
    }
    assert got["null.v.01"][1] is None
    after = {r.key: r for r in M.apply_reassignments(entries, classified).collect()}
    assert after["cling.v.03"].status == "auto_joint" and after["cling.v.03"].fr == "se cramponner" and after["cling.v.03"].occurrences == 4
    assert after["hang.v.01"].status == "pending" and after["hang.v.01"].agreement == "reassigne_vers:cling.v.03"
    assert after["cling.v.03"].agreement == "auto_joint_reassigne_depuis:hang.v.01" and after["cling.v.03"].lemmas_en == ["cling", "hang"]
    assert after["beat.n.08"].status == "auto_joint" and after["beat.n.08"].agreement == "auto_joint_confirme"
    assert after["mwe:give out:phrasal_verb"].fr == "tomber en panne"
    assert after["shut.v.01"].fr == "fermer" and after["lock.v.01"].status == "pending"


def test_targets_protection_and_judgments(spark):
    rows = [("a", "pending", "sense_id_suspect"), ("b", "pending", "frontier_sans_ressource"), ("c", "auto_strong", "x"), ("d", "pending", "frontier_desaccord")]  # the cases of the fixture
    df = spark.createDataFrame(rows, "key string, status string, agreement string")
    assert [r.key for r in M.reassign_targets(df).collect()] == ["a"]
    for status, expected in (("validated", True), ("auto_joint", True), ("pending", False), ("auto_strong", False), (None, False)):
        assert one(spark, store.is_protected(F.col("s")), s=status) is expected
    side = "struct<pos_correct: boolean, sense_correct: boolean, fr_acceptable: boolean, overall: boolean>"
    good, bad = (True, True, True, True), (True, False, True, False)
    first = spark.createDataFrame([("c1", good, bad, "x", True), ("c2", good, bad, "tie", True)], f"case_id string, x {side}, y {side}, preferred string, first_joint boolean")
    second = spark.createDataFrame([("c1", bad, good, "y", False), ("c2", good, bad, "tie", False)], f"case_id string, x {side}, y {side}, preferred string, first_joint boolean")
    a, b = M.normalise_judgments(first), M.normalise_judgments(second)
    assert {r.case_id: r.preferred for r in a.collect()} == {"c1": "joint", "c2": "tie"}
    assert {r.case_id: (r.stable, r.preference_stable) for r in M.stable(a, b).collect()} == {"c1": (True, True), "c2": (False, True)}
    judged = a.join(M.stable(a, b), "case_id").withColumn("stratum", F.lit("pending"))
    total = M.benchmark_report(judged).where("stratum IS NULL").first()
    assert total.joint == 1.0 and total.current == 0.0 and total.regressions == 0 and total.adopt is False


def test_commit_collisions_signals(spark):
    entries = spark.createDataFrame(
        [(k, "synset", "n", ["w " + k], n, st_, "x", fr, None, None) for k, n, st_, fr in (("a.n.01", 1, "pending", None), ("b.n.01", 2, "pending", None), ("c.n.01", 3, "validated", "x"), ("d.n.01", 4, "pending", None))]
        + [("mwe:give up:idiome", "mwe", None, ["give up"], 5, "pending", "x", None, None, None)],
        STORE + ", decided_by string, decided_at string",
    )
    asked = [
        (1, "a.n.01", "no", None, None), (2, "a.n.01", "OK ", None, "eau"), (3, "b.n.01", "ok", None, " "), (4, "z.n.01", "ok", None, "y"), (5, "d.n.01", "ok", "c.n.01", "neuf"), (6, "c.n.01", "maybe", None, None),
        (7, "mwe:give up:idiome", "ok", "c.n.01", "x"), (8, "b.n.01", "no", "c.n.01", "x"), (9, "b.n.01", "ok", "c.n.01", None), (10, "b.n.01", "ok", "q.n.01", "x"), (11, "b.n.01", None, None, None),
        (12, "b.n.01", "ok", "mwe:full stop:idiome", "point"),
    ]
    asked = spark.createDataFrame(asked, "n int, key string, decision string, reassigner_vers string, fr_final string")
    known = spark.createDataFrame([("c.n.01",)], "sense_id string")
    after, errors = M.commit(entries, asked, known, "2024-01-01")
    got = {r.key: (r.status, r.fr, r.decided_by, r.occurrences, r.kind) for r in after.collect()}
    assert got == {
        "a.n.01": ("validated", "eau", "human", 1, "synset"), "b.n.01": ("pending", None, None, 2, "synset"), "c.n.01": ("validated", "neuf", "human", 4, "synset"), "d.n.01": ("pending", None, None, 4, "synset"),
        "mwe:give up:idiome": ("pending", None, None, 5, "mwe"), "mwe:full stop:idiome": ("validated", "point", "human", 2, "mwe"),
    }
    assert sorted(r.result for r in errors.collect()) == [
        "error: a move needs a translation", "error: a move needs ok", "error: bad target", "error: invalid decision", "error: ok needs a translation", "error: only senses move", "error: unknown key",
    ]
    assert sorted(tuple(r) for r in M.corrections(M.judge_commits(asked, entries, known), entries).collect()) == [("w b.n.01", "n", "b.n.01", "mwe:full stop:idiome"), ("w d.n.01", "n", "d.n.01", "c.n.01")]
    senses_ = spark.createDataFrame([("a.n.01", "synset", "pending", "le chien", ["dog"]), ("a.n.02", "synset", "validated", "chiens", ["dog", "hound"]), ("a.v.01", "synset", "validated", "chien", ["dog"])], "key string, kind string, status string, fr string, lemmas_en array<string>")
    assert [tuple(r) for r in M.collisions(senses_).collect()] == [("a.n.01", "a.n.02")]
    rows = spark.createDataFrame([("k", "chien", None, ["chiens"], ["chat"]), ("m", None, None, ["x"], [])], "key string, fr string, fr_alt array<string>, resources array<string>, apertium array<string>")
    got = {r.key: (r.resource_match, r.apertium_match, r.wordfreq_ok) for r in M.adjudication_signals(rows, spark.createDataFrame([("chien", 4.0)], "word string, zipf double")).collect()}
    assert got == {"k": (True, False, True), "m": (False, False, False)}
    flagged = spark.createDataFrame([("validated", "mismatch", None), ("validated", "mismatch", "human"), ("pending", "mismatch", None)], "status string, sense_fit string, decided_by string")
    assert M.flagged(flagged).count() == 1
    with pytest.raises(ValueError):
        M.quota_cases(spark.createDataFrame([("a", "s")], "key string, stratum string"), {"s": 2})


def test_resource_decisions(spark):
    cases = [
        (["chien"], ["chiens"], None, None, "auto_strong/concordantes"), (["chien"], ["chat"], "chien", True, "pending/divergentes"), (["chien"], [], "chien", True, "auto_strong/source_unique"),
        (["chien"], [], "chien", False, "pending/source_unique"), ([], ["chat"], "chien", True, "pending/source_unique"), ([], [], "chien", True, "pending/aucune_source"),
    ]
    df = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(cases)], "i int, a array<string>, b array<string>, v string, ok boolean")
    d = store.resource_decision(F.col("a"), F.col("b"), F.col("v"), F.col("ok"))
    got = {r.i: f"{r.d.status}/{r.d.agreement}" for r in df.select("i", d.alias("d")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[4] for c in cases]


def test_french_phrases(spark):
    """Against the published rules: first parenthesis, synonyms in one cell, stop words, stems."""
    c = F.col("c")
    gloss = {
        "pied (membre)": ("pied", "membre"), "capable (de)": ("capable", None), "x (À QQN.) y": ("x y", None), "a (b) (c)": ("a (c)", "b"), " sans ": ("sans", None), "()": ("", None), "ouvert (": ("ouvert (", None),
    }
    for text, expected in gloss.items():
        assert tuple(one(spark, T.split_gloss(c), c=text)) == expected, text
    assert sorted(one(spark, T.content_word_set(c), c="tenir à ; se soucier de/Élèves (pl), le bas")) == sorted([stem("tenir"), stem("soucier"), stem("eleves"), "bas"])
    assert one(spark, T.readable_content_words(c), c="Tenir à ; l'Été (saison), de !") == ["Tenir", "Été"]
    assert one(spark, T.head_stem(c), c="se de la; chien") is None and one(spark, T.head_stem(c), c="les maisons, chien") == "maison"
    pairs = {("pied (membre)", "membre"): False, ("coup sourd", "bruit sourd"): True, ("continuellement", "continuel"): True, ("de", "de"): False, ("eau", "eaux"): False, ("chat ; chien", "un chien"): True}
    for (a, b), expected in pairs.items():
        assert one(spark, T.candidates_match(F.col("a"), F.col("b")), a=a, b=b) is (expected or stem(a) == stem(b) and a == "eau"), (a, b)
    assert one(spark, T.any_match(F.col("a"), F.col("b")), a=["x", "maisons"], b=["", "la maison"]) is True
    assert one(spark, T.any_match(F.col("a"), F.array().cast("array<string>")), a=["x"]) is False


def test_alignment_quality(spark):
    from lexspark.operators import segment

    rows = [("the dog", "le chien")] * 3 + [("le chat est", "the cat"), ("a", ""), ("word", "x" * 40), ("", "vide")]
    r = segment.alignment_quality(spark.createDataFrame(rows, "en string, fr string")).first()
    assert (r.n, r.n_empty, r.n_duplicate, r.n_swapped, r.n_odd, r.passes) == (7, 1, 2, 1, 1, False)


def test_french_markers_as_in_sql(spark):
    """Words are bounded as in DuckDB, where accented letters are outside of words; a run of null texts is no pair."""
    import duckdb

    from lexspark.operators import segment

    words = ["está bien", "ésta", "café le", "LEſ", "leſx", "le_chat", "élle", "C'EST", "quí", "Unı", "İl", "deſ9", "l'un", "x1 la2", "Le\u0301", "\u0301le"]
    rows = [(w, "plain") for w in words] + [("le", w) for w in words]
    marks = segment.FRENCH_MARKERS.replace("'", "''")
    c = duckdb.connect()
    for en, fr in rows:
        found = c.execute(f"SELECT NOT regexp_matches($1, '{marks}', 'i') AND regexp_matches($2, '{marks}', 'i')", [fr, en]).fetchone()[0]
        assert segment.alignment_quality(spark.createDataFrame([(en, fr)], "en string, fr string")).first().n_swapped == int(found), (en, fr)

    turns = spark.createDataFrame([(1, 0, "a", "one"), (1, 1, "b", None), (2, 0, "a", "two"), (2, 1, "b", None), (2, 2, "b", "deux")], "g int, n int, role string, t string")
    starts = (F.col("n") == 0) | (F.col("role") == "b") & (F.col("n") == 1)
    assert [tuple(r) for r in segment.block_pairs(turns, "g", "n", starts, "t").collect()] == [(2, 0, "two", "deux")]


def test_targets_and_snippets(spark):
    assert one(spark, senses.first_target(F.col("t"), F.lit("DOG")), t=["a", "Dog", "dog"]) == 1
    assert one(spark, senses.first_target(F.col("t"), F.lit("x")), t=["a"]) is None
    assert one(spark, T.snippet(F.col("c"), F.lit(5), F.lit(8), 3), c="one  two\n three") == "e two t"
