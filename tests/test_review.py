"""Review, purge, evidence, sense analysis and the whole run on small cases."""

import pytest
from pyspark.sql import functions as F

from lexspark import run
from lexspark.operators import analyse, answers, review, senses, signals, spans, units

STORE = "key string, kind string, pos string, lemmas_en array<string>, definition_en string, occurrences int, status string, agreement string, fr string, fr_alt array<string>"


@pytest.fixture(scope="module")
def store(spark):
    return spark.createDataFrame(
        [
            ("york.n.01", "synset", "n", ["york"], "a house", 3, "pending", "divergentes", "york", None), ("queens.n.01", "synset", "n", ["queen"], "a ruler", 9, "validated", "x", "reine", ["souveraine"]),
            ("mwe:give up:idiome", "mwe", None, ["give up"], "stop", 2, "pending", "mwe_sans_ressource", None, None),
        ],
        STORE,
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_purge_in_full(spark, store):
    lines = spark.createDataFrame([("york", "n", "york.n.01", "L1"), ("york", "n", "york.n.01", "L2"), ("queens", "n", "queens.n.01", "L3"), (None, None, None, "{broken")], "word string, pos string, best_sense string, raw string")
    tables = {
        "store": store, "lock": spark.createDataFrame([("queens.n.01", "reine")], "key string, fr string"), "senses": lines,
        "corrections": spark.createDataFrame([("york.n.01", "a"), ("b", "york.n.01"), ("c", "d"), (None, "e")], "wrong_sense_id string, new_key string"),
        "types": spark.createDataFrame([("york", "n"), ("queens", "n")], "lemma string, wn_pos string"), "occurrences": spark.createDataFrame([("york", "n", "x"), ("york", "v", "y"), (None, None, "{")], "lemma string, wn_pos string, raw string"),
        "suspects": spark.createDataFrame([("york.n.01",), ("z",)], "key string"), "adjudication": spark.createDataFrame([("z",)], "key string"),
    }
    done = review.purge("york.n.01", tables, "a place", "2024-01-01", export=lambda after: after["types"])
    assert done.removed == {"store": 1, "lock": 0, "corrections": 2, "senses": 2, "types": 1, "occurrences": 1, "suspects": 1, "adjudication": 0}
    assert rows(done.after["senses"].select("raw")) == [("L3",), ("{broken",)] and rows(done.after["export"]) == [("queens", "n")]
    assert [r.key for r in done.after["queue"].collect()] == ["mwe:give up:idiome"]
    assert done.log.first().removed["senses"] == 2
    with pytest.raises(ValueError):
        review.purge("nothing", tables)
    assert review.handle_purge(" ", tables)[0] == 400 and review.handle_purge("nothing", tables)[0] == 400 and review.handle_purge("york.n.01", tables)[0] == 200
    # a type with another sense left, or none that fits, stays
    kept = dict(tables, senses=spark.createDataFrame([("york", "n", "york.n.01", "L1"), ("york", "n", "aucun_sens_adapte", "L2")], lines.schema))
    assert review.purge("york.n.01", kept).removed["types"] == 0


def test_search_and_rows(spark, store):
    assert [r.key for r in review.search_store(store, "QUEEN").collect()] == ["queens.n.01"]
    assert [r.key for r in review.search_store(store, "ho").collect()] == ["york.n.01"] and review.search_store(store, " q ").count() == 0
    inventory = spark.createDataFrame([("mail.n.01", "n", "x", ["mail"], 3), ("e-mail.n.01", "n", "y", ["electronic_mail", "e-mail"], 1), ("mail.v.01", "v", "z", ["Mail"], 2), ("post.n.01", "n", "w", ["post"], 4)], "sense_id string, pos string, definition string, lemmas array<string>, n int")
    assert [r.sense_id for r in review.search_senses(inventory, "mail", 2).collect()] == ["mail.n.01", "mail.v.01"]
    assert [r.sense_id for r in review.search_senses(inventory, "electronic mail").collect()] == ["e-mail.n.01"]
    assert rows(review.page_search(store, inventory, "x", inventory.limit(1)).select("origin")) == [("own",)]
    lines = spark.createDataFrame([("york.n.01", f"sentence {k}", None, "york", k) for k in range(4)] + [("aucun_sens_adapte", "c", "t", "w", 1), ("q", None, "t", "w", 1)], "best_sense string, context string, target_surface string, word string, segment int")
    found = review.occurrences_by_sense(lines)
    assert found.count() == 4
    shown = {r.key: r for r in review.pending_rows(store, found).collect()}
    assert tuple(review.pending_rows(store, found).columns) == review.REVIEW_FIELDS and set(shown) == {"york.n.01", "mwe:give up:idiome"}
    assert shown["york.n.01"].contexte_en == "sentence 0 || sentence 1 || sentence 2" and shown["york.n.01"].decision == "" and shown["mwe:give up:idiome"].suggested_fr == ""
    exact, near = review.split_inventory(spark.createDataFrame([("E_mail",), ("mails",)], "lemma string"), "e mail")
    assert exact.count() == 1 and near.count() == 1


def test_store_steps(spark, store):
    targets = spark.createDataFrame([("york.n.01", "synset", ["york"], 1, "d"), ("new.n.01", "synset", ["new"], 2, "d"), ("mwe:x:idiome", "mwe", ["x"], 1, "d")], "key string, kind string, lemmas_en array<string>, occurrences int, definition_en string")
    assert rows(review.to_classify(targets, store).select("key")) == [("mwe:x:idiome",), ("new.n.01",)]
    assert rows(review.to_classify(targets, store, True, "divergentes").select("key")) == [("mwe:x:idiome",), ("new.n.01",), ("york.n.01",)]
    votes = spark.createDataFrame([("mwe:x:idiome", 1, "lâcher", "lach"), ("mwe:x:idiome", 2, "abandonner", "abandon"), ("mwe:x:idiome", 3, "abandonne", "abandon"), ("mwe:x:idiome", 4, "z", "z")], "key string, n int, fr string, stem string")
    r = review.classify_expressions(targets, votes).first()
    assert (r.fr, r.fr_alt, r.status, r.agreement) == ("abandonner", ["z", "lâcher", "abandonne"], "pending", "mwe_sans_ressource")
    verdicts = spark.createDataFrame([("york.n.01", "York (ville)", ["Y"], "high", False), ("mwe:give up:idiome", None, None, "high", True), ("queens.n.01", "x", None, "high", False)], "key string, fr string, fr_alt array<string>, confidence string, no_equivalent boolean")
    after = {r.key: (r.status, r.fr) for r in review.judged_entries(store, verdicts).collect()}
    assert after == {"york.n.01": ("auto_judged", "York"), "mwe:give up:idiome": ("no_equivalent", None), "queens.n.01": ("validated", "reine")}
    assert review.insert_absent(store, store.limit(1)).count() == 3
    known = spark.createDataFrame([("queens.n.01",)], "sense_id string")
    full = store.withColumns({"decided_by": F.lit(None).cast("string"), "decided_at": F.lit(None).cast("string")})
    ask = lambda *r: spark.createDataFrame([(1, *r)], "n int, key string, decision string, reassigner_vers string, fr_final string")
    assert review.handle_decision(full, ask("", "ok", None, "x"), known, "d")[0] == 400 and review.handle_decision(full, ask("york.n.01", "", None, "x"), known, "d")[0] == 400
    assert review.handle_decision(full, ask("york.n.01", "maybe", None, "x"), known, "d")[0] == 400
    code, answer, changed = review.handle_decision(full, ask("york.n.01", "ok", None, "York"), known, "d")
    assert code == 200 and answer["remaining"] == 1 and changed.where("status = 'validated'").count() == 2


def test_resource_signals(spark, store):
    entries = store.where("kind = 'synset'")
    known = spark.createDataFrame([("York", "n", 1, "a house", 0.44, ["york"]), ("york", "v", 2, "a house", 0.9, ["york"]), ("york", "n", 3, "a house", 0.5, ["duc"]), ("queen", "n", 1, "a ruler", 0.6, ["la reine"]), ("queen", "n", 2, "a ruler", 0.6, ["abeille"])], "lemma string, pos string, n int, definition_en string, score double, fr array<string>")
    assert rows(signals.dictionary_match(store, known)) == [("mwe:give up:idiome", False), ("queens.n.01", True), ("york.n.01", False)]
    pairs = spark.createDataFrame([("Queen", "les reines"), ("york", "duc")], "lemma string, fr string")
    assert rows(signals.attested(entries, pairs)) == [("queens.n.01", True), ("york.n.01", False)]
    lists = spark.createDataFrame([("york.n.01", ["a"]), ("mwe:give up:idiome", ["b"])], "key string, fr array<string>")
    got = {r.key: r for r in signals.resources_for(store, lists, lists, known, pairs).collect()}
    assert got["york.n.01"].omw_fr == ["a"] and got["york.n.01"].dbnary == ["duc"] and got["mwe:give up:idiome"].omw_fr == [] and got["queens.n.01"].apertium == ["les reines"]
    guesses = spark.createDataFrame([("york.n.01", "the Yorks"), ("queens.n.01", "to rule")], "key string, guess string")
    near = spark.createDataFrame([("queens.n.01", "Rule")], "key string, word string")
    assert rows(signals.back_translated(entries, guesses, near)) == [("queens.n.01", True), ("york.n.01", True)]
    assert signals.report_cost(1.0, 2.0) == 2.0 and signals.require_model("a", ("a",)) == "a"
    with pytest.raises(ValueError):
        signals.require_model("b", ("a",))
    d = spark.createDataFrame([(["C1", "?", "A2", "A2"], 1, 0), ([], 1, 3), (["B1"], 2, 3)], "l array<string>, n int, t int")
    assert [r[0] for r in d.select(signals.format_levels(F.col("l"))).collect()] == ["A2/C1/?", "?", "B1"]
    assert [r[0] for r in d.select(signals.highest_level(F.col("l"))).collect()] == ["C1", None, "B1"]
    assert [r.label for r in signals.combinations(d, "l").collect()] == ["A2/C1/?", "B1", "?"]
    assert [r[0] for r in d.select(signals.percent(F.col("n"), F.col("t"))).collect()] == ["n/a", "33.3%", "66.7%"]
    words = spark.createDataFrame([("cats",), ("bass",), ("xyz",)], "word string")
    ages = spark.createDataFrame([("cat", 3.0), ("bass", 9.0), ("bas", 1.0)], "word string, aoa double")
    assert rows(signals.youngest(words, ages)) == [("bass", "bass", 9.0), ("cats", "cat", 3.0)]
    graded = spark.createDataFrame([("cats", "n", "A1"), ("cats", "v", "B1")], "word string, pos string, level string")
    assert signals.inspect_levels(words, graded).where("found").count() == 2 and signals.inspect_levels(words, graded).count() == 4


def test_sense_analysis(spark):
    c = spark.createDataFrame(
        [
            ("clear", "a", 1, 0.9, 0.0), ("clear", "b", 2, 0.1, 0.0), ("close", "a", 1, 0.5, 0.0), ("close", "b", 2, 0.4, 0.0), ("zero", "a", 1, 0.0, 0.0), ("zero", "b", 2, 0.0, 0.0),
            ("split", "a", 1, 0.5, 0.0), ("split", "b", 2, 0.1, 0.9), ("one", "a", 1, 0.0, 0.3), ("unfit", "a", 1, 0.0, 0.0), ("odd", "a", 1, 0.0, 0.0), ("tie", "b", 2, 0.5, 0.0), ("tie", "a", 1, 0.5, 0.0),
        ],
        "word string, synset string, n int, gloss_score double, fr_score double",
    )
    arbitration = spark.createDataFrame([("clear", "b", 0.9), ("close", "b", 0.9), ("zero", "b", 0.5), ("unfit", "aucun_sens_adapte", 0.9), ("odd", "z", 0.9)], "word string, selected string, confidence double")
    got = {r.word: (r.best_sense, r.needs_review, r.asked) for r in senses.analyse_occurrences(c, arbitration, ["word"]).collect()}
    assert got == {
        "clear": ("a", False, False), "close": ("b", False, True), "zero": ("b", True, True), "split": ("b", True, True), "one": ("a", False, False), "unfit": ("aucun_sens_adapte", True, True),
        "odd": ("a", True, True), "tie": ("a", True, True),
    }


def test_analyser_and_gate(spark):
    seg = spark.createDataFrame([(1, "dialogue", "The dogs e-mailed Zorg, quickly!"), (2, "hors_oeuvre", "dogs"), (3, "dialogue", None)], "segment long, kind string, en string")
    forms = spark.createDataFrame([("dogs", "dog", "NOUN"), ("e-mailed", "e-mail", "VERB"), ("zorg", "zorg", "PROPN"), ("quickly", "quickly", "ADV")], "form string, lemma string, upos string")
    found = analyse.occurrences(seg, forms, special=("e-mailed",))
    assert [(r.surface, r.lemma, r.wn_pos) for r in found.orderBy("pos").collect()] == [("The", "the", None), ("dogs", "dog", "n"), ("e-mailed", "e-mail", "v"), ("Zorg", "zorg", "n"), ("quickly", "quickly", "r")]
    assert rows(analyse.content(found).select("lemma")) == [("dog",), ("quickly",), ("zorg",)]
    own = analyse.occurrences(seg, analyser=lambda: lambda texts: [[(w, w.lower(), "NOUN") for w in t.split()] for t in texts])
    assert own.count() == 5
    empty = lambda ddl: spark.createDataFrame([], ddl)
    prevalence = spark.createDataFrame([("dog", 0.5, 60, 4.0), ("quickly", 0.99, 60, 4.0)], "lemma string, pknown double, nobs long, zipf double")
    levels = spark.createDataFrame([("quickly", "r", ["A1"])], "lemma string, wn_pos string, cefr_levels array<string>")
    gate = analyse.gated(analyse.types(analyse.content(found)), prevalence, levels, empty("lemma string, wn_pos string"))
    assert rows(gate.select("lemma", "prevalence_source", "drop_reason")) == [("dog", "found", "pknown"), ("quickly", "found", "cefr"), ("zorg", "absent", "named_entity")]
    two = spark.createDataFrame([("i", 1, 0, 1, 1), ("i", 1, 0, 2, 2), ("i", 1, 0, 2, 1)], "idiom string, segment int, start int, end int, n int")
    assert rows(spans.structural(two, "n")) == [("i", 1, 0, 2, 1)]


def test_units(spark):
    lines = spark.createDataFrame(
        [(1, "ass", "n", "ass.n.02", "asses", "old", ["âne"], False), (2, "ass", "n", "ass.n.01", None, "animal", ["âne"], True), (3, "ass", "n", "ass.n.01", "Ass", "animal", [], False), (4, "x", "n", "aucun_sens_adapte", "x", None, [], True), (5, "god", "n", "god.n.01", "God", "d", [], False)],
        "segment long, word string, pos string, best_sense string, target_surface string, definition string, fr_hits array<string>, needs_review boolean",
    )
    types = spark.createDataFrame([("ass", "n", 4.0)], "lemma string, wn_pos string, zipf double")
    fix = spark.createDataFrame([("ass", "n", "ass.n.02", "smart-ass", None, "smart.n.01", "smart-", "clever")], run.RESOURCES["corrections"])
    records = units.build_records(lines, types, fix)
    assert rows(records.select("form", "form_pos", "sense_id", "surface", "definition")) == [("ass", "n", "ass.n.01", "Ass", "animal"), ("ass", "n", "ass.n.01", "ass", "animal"), ("god", "n", "god.n.01", "God", "d"), ("smart-ass", "n", "smart.n.01", "smart-asses", "clever")]
    kept = spark.createDataFrame([("ass.n.01", "validated", "ane", ["baudet", "bourrique"]), ("smart.n.01", "pending", "x", None)], "key string, status string, fr string, fr_alt array<string>")
    store = units.official(kept, spark.createDataFrame([("baudet", 1.0), ("bourrique", 2.0)], "word string, zipf double"))
    counts = spark.createDataFrame([("ass", "n", "ass.n.01", 3), ("ass", "n", "ass.n.02", 1)], "word string, pos string, sense_id string, n long")
    found = units.word_units(records, spark.createDataFrame([("god.n.01",)], "sense_id string"), store, counts, spark.createDataFrame([("ass", 8.0)], "word string, aoa double"))
    got = {r.canonical_form: r for r in found.collect()}
    assert set(got) == {"ass", "smart-ass"}
    r = got["ass"]
    assert (r.occurrences, r.dispersion, r.confidence, r.needs_review, r.surface_forms, r.meaning_fr_alt, r.fr_status) == (2, 2, 0.5, True, ["Ass", "ass"], "bourrique/baudet", "validated")
    assert r.zipf_need == 0.5 and r.sense_surprise == 0.25 and r.aoa_component == pytest.approx(0.5 - (8 - (12 - 4.4)) / 8) and r.fr_opacity < 0.7
    assert r.score_comprehension == pytest.approx(0.4 * 0.5 + 0.2 * r.aoa_component + 0.15 * r.fr_opacity + 0.15 * 0.25 + 0.1 * r.book_gain)
    assert got["smart-ass"].meaning_fr == "âne" and got["smart-ass"].meaning_fr_official is None and got["smart-ass"].fr_status == "pending"
    said = spark.createDataFrame([(1, 0, "give up", "gave up", "idiome", 0.55), (2, 0, "give up", "give up", "semi_fige", 0.9)], "segment long, start int, idiom string, surface string, label string, confidence double")
    e = units.expression_units(said, spark.createDataFrame([("give up", "stop")], "idiom string, definition string"), store).first()
    assert (e.sense_id, e.needs_review, e.fr_opacity, e.definition_en, e.dispersion) == ("idiome", True, 0.9, "stop", 2)
    goals = units.collect_targets(units.all_units(found, units.expression_units(said, spark.createDataFrame([("give up", "stop")], "idiom string, definition string"), store)))
    assert rows(goals.select("key", "kind", "occurrences")) == [("ass.n.01", "synset", 2), ("mwe:give up:idiome", "mwe", 2), ("smart.n.01", "synset", 1)]
    known = spark.createDataFrame([("ass.n.01", "n", "d", ["ass", "donkey"])], "sense_id string, pos string, definition string, lemmas array<string>")
    resolved, waiting = units.resolved_targets(goals, known)
    assert rows(waiting.select("key", "agreement")) == [("smart.n.01", "sense_id_non_resolu")] and resolved.where("key = 'ass.n.01'").first().lemmas_en == ["ass", "donkey"]


def test_whole_run(spark, tmp_path):
    texts = spark.createDataFrame([(1, "Dogs give up quickly.\n(He sits)\nA dog.")], "doc_id long, text string")
    given = {
        "texts": texts, "forms": spark.createDataFrame([("dogs", "dog", "NOUN"), ("dog", "dog", "NOUN"), ("quickly", "quickly", "ADV")], "form string, lemma string, upos string"),
        "expressions": spark.createDataFrame([("give up", "idiome", 0.9, "stop")], "idiom string, label string, confidence double, definition string"),
        "candidates": spark.createDataFrame([(1_000_001, "dog", "n", "dog.n.01", 1, "animal", 0.9, 0.0, []), (1_000_003, "dog", "n", "dog.n.01", 1, "animal", 0.9, 0.0, [])], run.RESOURCES["candidates"]),
    }
    out = str(tmp_path / "out")
    assert run.run(spark, given, out) == list(run.STAGES)
    listed = spark.read.parquet(f"{out}/export")
    assert rows(listed.select("canonical_form", "occurrences")) == [("dog", 2), ("give up", 1)]
    assert run.run(spark, given, out, from_stage="vocabulary") == ["vocabulary", "export"] and run.run(spark, given, out, only="types") == ["types"]
    with pytest.raises(ValueError):
        run.run(spark, given, out, only="nothing")


def test_best_segment_and_answers(spark):
    seg = spark.createDataFrame([(1, "dialogue", "We eat."), (2, "dialogue", "It is a very high standard, really so"), (3, "dialogue", "standard of a high kind"), (4, "hors_oeuvre", "standard high very it")], "segment long, kind string, en string")
    ask = spark.createDataFrame([(1, "standard", "a very high standard"), (2, "kind", "a kind with high hopes"), (3, "we", "We eat!"), (4, "none", "nothing here")], "id int, word string, en string")
    assert rows(signals.best_segment(ask, seg)) == [(1, 2), (2, 3), (3, 1)]
    said = spark.createDataFrame([("a", '{"fr": "eau", "n": 1}'), ("b", '{"n": 1}'), ("c", "broken"), ("d", None)], "key string, answer string")
    assert rows(answers.parsed(said, "fr string, n int", ("fr",)).where("value IS NOT NULL").select("key")) == [("a",)]
    assert tuple(answers.total_cost(spark.createDataFrame([(0.5, False), (None, True)], "cost double, failed boolean")).first()) == (0.5, 1)
    sense = "array<struct<sense_id: string, pos: string, definition: string>>"
    q = spark.createDataFrame([("k", "synset", ["w"], "n", "d", [("s1", "n", "x")], ["e"])], f"key string, kind string, l array<string>, pos string, d string, i {sense}, e array<string>")
    assert "candidate: s1" in q.select(answers.reassignment_prompt("key" and F.col("key"), F.col("kind"), F.col("l"), F.col("pos"), F.col("d"), F.col("i"), F.col("e"))).first()[0]
    assert q.select(answers.arbitration_prompt(F.col("key"), F.col("pos"), F.col("d"), F.col("i"))).first()[0].endswith("- s1: x")


def test_contexts_and_cases(spark, store):
    turns = spark.createDataFrame([(1, k, f"t{k}") for k in range(6)], "g int, n int, text string")
    two = spark.createDataFrame([(1, 2, 3), (1, 0, 0)], "g int, first int, last int")
    got = {r["first"]: (r.context, r.context[r.start : r.end]) for r in senses.span_context(turns, two, "g", "n", "text", 1).collect()}
    assert got == {2: ("t1 t2 t3 t4", "t2 t3"), 0: ("t0 t1", "t0")}
    said = spark.createDataFrame([("give up", "idiome", [1, 2])], "canonical_form string, label string, segments array<long>")
    seen = spark.createDataFrame([("give up", 1, 0, "gave up"), ("give up", 1, 5, "gives up")], "idiom string, segment long, start int, surface string")
    context = spark.createDataFrame([(1, "c1"), (2, "c2")], "segment long, context string")
    assert rows(senses.expression_occurrences(said, seen, context)) == [("mwe:give up:idiome", 1, "c1", "gives up"), ("mwe:give up:idiome", 2, "c2", "give up")]
    lines = spark.createDataFrame([(1, "dogs", "the cats and dogs")], "id int, word string, en string")
    french = spark.createDataFrame([("cats", "chats"), ("dogs", "chiens"), ("the", "le")], "word string, fr string")
    assert senses.claimed_stems(lines, french).first().claimed == ["chat", "dog", "le"]
    occ = spark.createDataFrame([("york.n.01", 4, "in york", None)], "key string, segment long, context string, target_surface string")
    inventory = spark.createDataFrame([("york", "n", "york.n.01", "a house")], "lemma string, pos string, sense_id string, definition string")
    full = store.withColumns({"omw_fr": F.array(F.lit("b"), F.lit("a")), "wonef": F.array(F.lit("a"))})
    r = review.cases_from_store(full, occ, inventory, "pending").first()
    assert (r.case_id, r.target_surface, r.fr_candidates, r.current.sense_id) == ("store:york.n.01:4", "york", ["b", "a"], "york.n.01")
    lost = spark.createDataFrame([("york", "n", "aucun_sens_adapte", "York", "c", 7)], "word string, pos string, best_sense string, target_surface string, context string, segment int")
    assert review.cases_from_none(lost, inventory).first().case_id == "none:york:n:7"
