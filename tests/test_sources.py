"""Readers and writers on small files."""

import bz2

import pytest

from lexspark.sources import readers as R
from lexspark.sources import sinks as S


def write(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_play(spark, tmp_path):
    path = write(
        tmp_path, "play.txt", "THE TITLE\nshort\nCopyright 2001 by someone, all rights reserved\nA room in a house somewhere\n\nANNA\nHello there my friend.\nWell?\n(She sits)\nBOB\nJohn walks to the door\nIN CAPITALS BUT EXCLUDED\n"
    )
    got = rows(R.PlayAdapter([(12, 12)]).segments(spark, path).select("idx", "en", "kind", "speaker"), "idx")
    assert got == [
        (0, "Copyright 2001 by someone, all rights reserved", "hors_oeuvre", "THE TITLE"), (1, "A room in a house somewhere", "dialogue", "THE TITLE"), (2, "Hello there my friend.", "dialogue", "ANNA"),
        (3, "Well?", "dialogue", "ANNA"), (4, "(She sits)", "didascalie", "ANNA"), (5, "John walks to the door", "didascalie", "BOB"), (6, "IN CAPITALS BUT EXCLUDED", "hors_oeuvre", "BOB"),
    ]


def test_pairs(spark, tmp_path):
    expected = [("a b", "c"), ("d", "e f")]
    assert rows(R.read_pairs(spark, write(tmp_path, "p.jsonl", '{"en": " a b", "fr": "c"}\n\n{"en": "d", "fr": "e f"}\n')), "en") == expected
    assert rows(R.read_pairs(spark, write(tmp_path, "p.tsv", "a b\tc\nd \te f\n")), "en") == expected
    assert rows(R.read_pairs(spark, write(tmp_path, "p.txt", "a\nb\n\nc\n\n\nd\n\ne\nf\n\nodd\n")), "en") == expected
    with pytest.raises(Exception):  # noqa: B017
        R.read_pairs(spark, write(tmp_path, "bad.jsonl", '{"en": \n')).collect()


def test_prevalence(spark, tmp_path):
    path = write(tmp_path, "prev.csv", "word,0.5,10,0.1,3.2\nshort,1\nbad,x,1,1,1\ndot,0.9,12.0,1.5,4\nWord,0.7,11,0.2,3.3\n")
    assert rows(R.prevalence(spark, path), "word") == [("dot", 0.9, 12, 1.5, 4.0), ("word", 0.7, 11, 0.2, 3.3)]
    assert rows(R.prevalence(spark, path, whole_counts=True).select("word")) == [("word",)]


def test_levels_ages_lists(spark, tmp_path):
    path = write(tmp_path, "cefr.csv", "﻿headword;pos;CEFR\nwater;noun;A1\nwater;verb;B2\nWater;noun;b1\n;noun;A1\n")
    assert rows(R.graded_words(spark, path), "word", "pos") == [("water", "noun", ["A1", "B1"]), ("water", "verb", ["B2"])]
    path = write(tmp_path, "alt.csv", "headword,pos,CEFR\ncolour/color,noun,A1\nx,noun,Z9\n")
    assert rows(R.graded_variants(spark, path), "word") == [("color", "noun", ["A1"]), ("colour", "noun", ["A1"])]
    assert rows(R.ages(spark, write(tmp_path, "aoa.csv", "Word,Rating.Mean\nopera,7.5\nopus,NA\nopera,8\n"))) == [("opera", 8.0)]
    assert rows(R.word_list(spark, write(tmp_path, "w.txt", "B\na\n\nb\n")), "word") == [("a",), ("b",)]
    assert rows(R.list_tiers(spark, write(tmp_path, "t.csv", "austerity\t3.69\t13\naberration\t3.23\t14\n")), "word") == [("aberration", 3.23, 14), ("austerity", 3.69, 13)]


def test_xml(spark, tmp_path):
    xml = "<R><SYNSET><ID>eng-30-1-n</ID><SYNONYM><LITERAL>eau</LITERAL><LITERAL> onde </LITERAL></SYNONYM></SYNSET><SYNSET><ID>eng-30-2-n</ID><SYNONYM><LITERAL>_EMPTY_</LITERAL></SYNONYM></SYNSET></R>"
    assert rows(R.wordnet_literals(spark, write(tmp_path, "w.xml", xml))) == [("eng-30-1-n", ["eau", "onde"])]
    dix = '<d><section>\n<e><p><l>give<b/>up<s n="v"/></l><r>abandonner<s n="v"/></r></p></e>\n<e r="LR"><p><l>Give<b/>up</l><r>céder</r></p></e><e><p><l>x</l><r></r></p></e></section></d>'
    assert rows(R.apertium(spark, write(tmp_path, "d.dix", dix))) == [("give up", ["abandonner", "céder"])]
    bnc = '<c><u n="1" who="S1"><w lemma="run" pos="VERB" class="VERB" usas="M1">ran</w><w lemma="away" pos="ADV" class="ADV" usas="M6">away</w><w lemma="x" pos="x" class="x" usas="x"> </w></u></c>'
    assert rows(R.spoken_words(spark, write(tmp_path, "s.xml", bnc)).select("utterance", "who", "pos_in", "surface", "lemma")) == [("1", "S1", 0, "ran", "run"), ("1", "S1", 1, "away", "away")]


def test_dbnary(spark, tmp_path):
    text = (
        'eng:__en_gloss_1_dog__Noun__1 rdf:value "an animal" ; dbnary:rank 1 .\neng:__tr_fra_1 dbnary:gloss eng:__en_gloss_1_dog__Noun__1 ; dbnary:writtenForm "chien"@fr .\n'
        'eng:__en_gloss_2_give_up__Verb__1 rdf:value "to stop" .\neng:__tr_fra_2 dbnary:gloss eng:__en_gloss_2_give_up__Verb__1 ; dbnary:writtenForm "cesser"@fr .\neng:other x y .\n'
    )
    path = tmp_path / "d.ttl.bz2"
    path.write_bytes(bz2.compress(text.encode()))
    got = rows(R.dbnary(spark, str(path)).select("lemma", "pos", "gloss_en", "fr"), "lemma")
    assert got == [("dog", "Noun", "an animal", ["chien"]), ("give up", "Verb", "to stop", ["cesser"])]
    assert R.dbnary(spark, str(path), spark.createDataFrame([("dog",)], "lemma string")).count() == 1


def test_own_files(spark, tmp_path):
    path = write(tmp_path, "k.key", "take d0.s0.t0 take%2:30:01::\nbad line\n")
    assert rows(R.sense_keys(spark, path).select("lemma", "sense_key")) == [("take", "take%2:30:01::")]
    path = write(tmp_path, "t.jsonl", '{"key": "a", "fr": "x"}\n{corrupted\n\n{"key": "a", "fr": "y"}\n')
    assert rows(R.tolerant_jsonl(spark, path, "key string, fr string"), "raw", "fr") == [("a", "x", None), ("a", "y", None), (None, None, "{corrupted")]
    with pytest.raises(Exception):  # noqa: B017
        R.strict_jsonl(spark, path, "key string, fr string", "key").collect()
    path = write(tmp_path, "s.jsonl", '{"key": "a", "fr": "x"}\n{"key": "b", "fr": "z"}\n{"key": "a", "fr": "y"}\n')
    assert rows(R.strict_jsonl(spark, path, "key string, fr string", "key"), "key") == [("a", "y"), ("b", "z")]
    assert R.first_existing(spark, [str(tmp_path / "no"), path]) == path
    custom = spark.createDataFrame([("idiom", "kick", "die", None), ("tokenizer", None, None, ["e-mail", "e-mail"])], "kind string, lemma string, definition_en string, surfaces array<string>")
    base = spark.createDataFrame([("kick", "hit"), ("bite", "eat")], "lemma string, definition_en string")
    assert rows(R.with_custom(base, R.custom_idioms(custom)), "lemma") == [("bite", "eat"), ("kick", "die")]
    assert rows(R.tokenizer_surfaces(custom)) == [("e-mail",)]
    senses = spark.createDataFrame([("b.s.01", "big", "s"), ("b.a.01", "big", "a"), ("b.n.01", "big", "n")], "sense_id string, lemma string, pos string")
    assert rows(R.synsets(senses, spark.createDataFrame([("big", "a")], "word string, pos string")).select("sense_id")) == [("b.a.01",), ("b.s.01",)]


def test_files_in_splits(spark, tmp_path):
    """Large files are read in splits, and the last of equal keys still counts."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        path = write(tmp_path, "p.csv", "".join(f"w{k % 50},0.5,{k},0.1,3\n" for k in range(1000)))
        assert spark.read.text(path).rdd.getNumPartitions() > 3
        assert {r.word: r.nobs for r in R.prevalence(spark, path).collect()} == {f"w{k}": 950 + k for k in range(50)}
        path = write(tmp_path, "s.jsonl", "".join('{"key": "k%d", "v": %d}\n' % (k % 7, k) for k in range(700)))
        assert {r.key: r.v for r in R.strict_jsonl(spark, path, "key string, v int", "key").collect()} == {f"k{k}": 693 + k for k in range(7)}
        path = write(tmp_path, "d.dix", "<d><section>" + "".join(f'<e><p><l>w{k % 9}</l><r>m{k}</r></p></e>\n' for k in range(300)) + "</section></d>")
        assert {r.en: r.fr for r in R.apertium(spark, path).collect()} == {f"w{j}": [f"m{k}" for k in range(j, 300, 9)] for j in range(9)}
        ttl = "@prefix eng: <x> .\n" + "".join(f'eng:__en_gloss_{k}_cat_fish__Noun__1 a dbnary:Gloss ;\n  rdf:value "a. b {k}" .\n' for k in range(100)) + "".join(f'eng:__tr_fra_{k} dbnary:gloss eng:__en_gloss_{k}_cat_fish__Noun__1 ;\n  dbnary:writtenForm "poisson {k}"@fr .\n' for k in range(100))
        got = R.dbnary(spark, write(tmp_path, "d.ttl", ttl)).collect()
        assert {(r.gloss_id.split("_")[0], r.gloss_en, r.fr[0], r.lemma) for r in got} == {(str(k), f"a. b {k}", f"poisson {k}", "cat fish") for k in range(100)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_word_keys_and_inventories(spark, tmp_path):
    for name in ("v/take.key", "v/take_off.key", "n/take.key"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(f"{name.split('/')[1][:-4]} i1 take%2:1:1\nshort line\ntake i2 take%2:1:2\n")
    found = R.word_keys(spark, str(tmp_path), "Take")
    assert found.count() == 4 and R.word_keys(spark, str(tmp_path), "take off").count() == 2
    index = spark.createDataFrame([("take%2:1:1", "take.v.01")], "sense_key string, sense_id string")
    assert rows(R.sense_counts(found, index), "sense_id") == [(None, 2), ("take.v.01", 2)]
    senses = spark.createDataFrame([("cat.n.01", "cat", "n"), ("cat.n.01", "Cats", "n"), ("cat.v.01", "cat", "v"), ("dog.n.01", "dog", "n")], "sense_id string, lemma string, pos string")
    assert rows(R.open_inventory(senses, "cats").select("sense_id")) == [("cat.n.01",), ("cat.v.01",)]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "bad.xml").write_text('<x><u n="1"><w>a</w></u><u n="2"><w>b</v></u></x>')
    assert len(R.unreadable_files(spark, str(tmp_path / "t")).collect()) == 1


def test_sinks(spark, tmp_path):
    units = spark.createDataFrame([("b", ["x", "y"], 0.12345, True), ("a", ["z"], 0.5, False)], "canonical_form string, surface_forms array<string>, score_default double, needs_review boolean")
    S.write_csv(units, str(tmp_path / "u"))
    written = spark.read.csv(str(tmp_path / "u"), header=True)
    assert tuple(written.columns) == S.EXPORT and written.where("sense_id IS NOT NULL").count() == 0
    assert rows(written.select("canonical_form", "surface_forms", "score_default", "needs_review"), "canonical_form") == [("a", "z", "0.5", "false"), ("b", "x/y", "0.123", "true")]
    assert S.review_queue(units).first().score_default == 0.12345
    S.write_jsonl(units, str(tmp_path / "j"))
    S.append_jsonl(units, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 4
    store = spark.createDataFrame([("k2", "v"), ("k1", "w")], "key string, fr string")
    path = str(tmp_path / "store")
    S.write_store(store, path)
    S.write_store(spark.read.json(path).union(spark.createDataFrame([("x", "k0")], "fr string, key string")), path)
    assert rows(spark.read.json(path).select("key"), "key") == [("k0",), ("k1",), ("k2",)]
    S.write_columns(store, ["key", "note"], str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == ["key", "note"]
    assert "| k2 | v |" in S.report(spark, store, store, store)
    asked = spark.createDataFrame([("p1",), ("p2",)], "prompt string")
    cache = asked.where("prompt = 'p1'").select(S.prompt_key("m", "s").alias("key")).selectExpr("key", "'yes' AS answer")
    hits, todo = S.answered(asked, cache, "m", "s")
    assert [r.prompt for r in hits.collect()] == ["p1"] and [r.prompt for r in todo.collect()] == ["p2"]
