"""Text as columns: every function takes and gives Columns, so Catalyst can fold, prune and push them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexspark.functions.kernels import french_stems

#: Accented Latin letters and their bare ones.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāăąćčďēęěğīįłńňōőŕřśšţťūůűźżžÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
BARE = "aaaaaaceeeeiiiinooooouuuuyyaaaccdeeegiilnnoorrssttuuuzzzAAAAAACEEEEIIIINOOOOOUUUUY"
#: Patterns of lines that mark front matter, whatever their case.
FRONT_MATTER_PATTERNS = (
    r"\ball rights reserved\b",
    r"\bno part of this (?:book|publication)\b",
    r"\bphotocopying\b",
    r"\bwithout (?:the )?(?:prior )?(?:written )?permission\b",
    r"\bISBN\b",
    r"\bLibrary of Congress\b",
    r"\bpublished by\b",
    r"\bfirst (?:published|edition)\b",
    r"\bcopyright\b",
    r"^\s*table of contents\s*$",
    r"^\s*contents\s*$",
    r"^\s*cast of characters\s*$",
    r"^\s*acknowledg(e)?ments\s*$",
)
FRONT_MATTER = "(?i)" + "|".join(FRONT_MATTER_PATTERNS)
#: How stage directions begin.
STAGE_VERBS = r"^[A-Z][a-z]+ (walks|enters|exits|sits|stands|stares|looks)\b"
#: French words that are no head of a phrase, and further ones without content.
HEAD_MARKERS = ("se", "s", "le", "la", "les", "l", "un", "une", "de", "du", "des", "d", "a", "à", "au", "aux", "en")
STOP_WORDS = (*HEAD_MARKERS, "etre", "avoir", "que", "qui", "ce", "cette", "ces", "son", "sa", "ses", "qqn", "qqch")
#: Parentheses that tell how a word is used and are no gloss.
USAGE_MARKS = ("de", "d'", "a", "à", "au", "aux", "du", "des", "qqn", "qqch", "qqn.", "qqch.", "de qqch", "de qqn", "a qqn", "a qqch", "à qqn", "à qqch", "qqn de qqch", "se", "s'")
#: What parts synonyms in one cell.
SYNONYMS = "[;/,]"


def fold(c: Column) -> Column:
    """Lower case, with the sharp s written out."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def strip_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, BARE)


def fr_stem(c: Column) -> Column:
    """Folded, without accents, without one final s or x if more than three letters are left with it."""
    return F.regexp_replace(strip_accents(fold(c)), "^(.{3,})[sx]$", "$1")


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0))


def apostrophe_words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("[A-Za-z]+(?:'[A-Za-z]+)?"), F.lit(0))


def content_words(c: Column, target: Column | None = None) -> Column:
    """Distinct folded words longer than two, but the target."""
    found = F.array_distinct(F.filter(F.regexp_extract_all(fold(c), F.lit("[a-z']+"), F.lit(0)), lambda w: F.length(w) > 2))
    return found if target is None else F.array_remove(found, fold(target))


def fr_tokens(c: Column) -> Column:
    return F.filter(F.split(fold(F.replace(c, F.lit("’"), F.lit("'"))), "[^a-zà-ÿ]+"), lambda w: F.length(w) > 2)


def stems_of(c: Column) -> Column:
    return F.array_distinct(F.transform(fr_tokens(c), fr_stem))


def normalize_phrase(c: Column) -> Column:
    """Folded, accents and hyphens gone, only letters, digits, apostrophes and single blanks left."""
    bare = F.regexp_replace(strip_accents(fold(c)), "-", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "[^a-z0-9' ]", " "), " +", " "))


_PARENTHESIS = r"(?s)^(.*?)\(([^)]*)\)(.*)$"


def without_gloss(c: Column) -> Column:
    """The text without its first parenthesis."""
    whole = F.concat(F.regexp_extract(c, _PARENTHESIS, 1), F.regexp_extract(c, _PARENTHESIS, 3))
    return F.when(c.rlike(_PARENTHESIS), F.regexp_replace(F.trim(whole), r"\s+", " ")).otherwise(F.trim(c))


def split_gloss(c: Column) -> Column:
    """(head, gloss): the first parenthesis is the gloss unless it is a usage mark; further ones stay in the head."""
    inside = F.trim(F.regexp_extract(c, _PARENTHESIS, 2))
    usage = F.btrim(strip_accents(fold(inside)), F.lit(" .")).isin(*USAGE_MARKS)
    return F.struct(without_gloss(c).alias("head"), F.when((inside != "") & ~usage, inside).alias("gloss"))


def clean_tokens(c: Column) -> Column:
    """Folded words without accents; hyphens and apostrophes part them."""
    bare = F.regexp_replace(F.regexp_replace(strip_accents(fold(c)), "[-']", " "), "[^a-z0-9 ]", " ")
    return F.filter(F.split(bare, " +"), lambda w: w != "")


def content_parts(c: Column) -> Column:
    """For each synonym of a cell its content words, folded, in order: no gloss, no stop words, none of two letters or fewer."""
    own = lambda part: F.filter(clean_tokens(without_gloss(part)), lambda w: (F.length(w) > 2) & ~w.isin(*STOP_WORDS))
    return F.transform(F.split(c, SYNONYMS), own)


def content_word_set(c: Column) -> Column:
    """The stems of all content words of a cell."""
    return F.array_distinct(F.flatten(french_stems(F.coalesce(content_parts(c), F.array().cast("array<array<string>>")))))


def readable_content_words(c: Column) -> Column:
    """The content words of a cell as they are written."""

    def own(part: Column) -> Column:
        bare = F.transform(F.split(without_gloss(part), r"[-'\s]+"), lambda w: F.btrim(w, F.lit(" .,;:!?\"'()")))
        key = lambda w: strip_accents(fold(w))
        return F.filter(bare, lambda w: (F.length(key(w)) > 2) & ~key(w).isin(*STOP_WORDS))

    return F.flatten(F.transform(F.split(c, SYNONYMS), own))


def head_stem(c: Column) -> Column:
    """The stem of the first synonym's first content word; null if it has none."""
    first = F.transform(F.slice(content_parts(c), 1, 1), lambda words: F.slice(words, 1, 1))
    return F.get(F.flatten(french_stems(F.coalesce(first, F.array().cast("array<array<string>>")))), F.lit(0))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all of two sets; two empty ones share nothing."""
    return F.when(F.size(F.array_union(a, b)) > 0, F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(0.0)


def candidates_match(a: Column, b: Column) -> Column:
    """Two cells match if they share a content word's stem (as equal heads do)."""
    return F.coalesce(F.arrays_overlap(content_word_set(a), content_word_set(b)), F.lit(False))


def any_match(candidates: Column, resources: Column) -> Column:
    """Whether any candidate matches any resource: their content words are put together, as one shared stem is enough."""
    parts = lambda values: F.flatten(F.transform(F.array_compact(F.coalesce(values, F.array().cast("array<string>"))), content_parts))
    words = lambda values: F.array_distinct(F.flatten(french_stems(parts(values))))
    return F.coalesce(F.arrays_overlap(words(candidates), words(resources)), F.lit(False))


def back_translation_key(c: Column) -> Column:
    """Folded, without one leading article or particle, then without outer punctuation."""
    return F.btrim(F.regexp_replace(F.trim(fold(c)), r"^(to|the|a|an)\s+", ""), F.lit(" .,;:!?\"'"))


def clean_candidates(values: Column, english: Column) -> Column:
    """Trimmed, without empty marks and English copies, in order, each once."""
    kept = F.filter(F.transform(values, lambda x: F.trim(x)), lambda x: (x != "") & (x != "_EMPTY_") & (F.lower(x) != F.lower(english)))
    return F.array_distinct(kept)


def looks_inflected(c: Column) -> Column:
    return c.rlike("(ing|ed|ies|es|s)$")


def base_forms(c: Column) -> Column:
    """Candidate base forms of an inflected word, by suffix."""
    cut = lambda n: F.substring(c, F.lit(1), F.length(c) - n)
    forms = F.array(
        c,
        F.when(c.rlike("ies$"), F.concat(cut(3), F.lit("y"))),
        F.when(c.rlike("es$"), cut(2)),
        F.when(c.rlike("s$"), cut(1)),
        F.when(c.rlike("ed$"), cut(2)),
        F.when(c.rlike("ed$"), cut(1)),
        F.when(c.rlike("ing$"), cut(3)),
        F.when(c.rlike("ing$"), F.concat(cut(3), F.lit("e"))),
    )
    return F.array_distinct(F.array_compact(forms))


def parse_alternatives(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ";"), lambda x: F.trim(x)), lambda x: x != "")


def sense_pos(sense_id: Column) -> Column:
    """The part of speech inside a sense id; the word may hold dots, so it is read from the end."""
    return F.try_element_at(F.split(sense_id, r"\."), F.lit(-2))


def same_pos(a: Column, b: Column) -> Column:
    """Satellite adjectives are adjectives."""
    plain = lambda c: F.when(c == "s", F.lit("a")).otherwise(c)
    return plain(a) == plain(b)


def expand_pos(c: Column) -> Column:
    return F.when(c == "a", F.array(F.lit("a"), F.lit("s"))).otherwise(F.array(c))


def dictionary_id(c: Column) -> Column:
    """From omw-en-OFFSET-POS to eng-30-OFFSET-POS; null unless the offset is all digits."""
    return F.when(c.rlike("^omw-en-[0-9]+-[a-z]$"), F.regexp_replace(c, "^omw-en-([0-9]+)-([a-z])$", "eng-30-$1-$2"))


def match_key(lemma: Column, stems: Column, normalized: Column) -> Column:
    """The key under which a French lemma occurs in a sentence: compounds as phrases, others by stem; else null."""
    phrase = normalize_phrase(lemma)
    compound = lemma.rlike("[ -]")
    return F.when(compound & F.contains(normalized, phrase), phrase).when(~compound & F.array_contains(stems, fr_stem(lemma)), fr_stem(lemma))


def detokenize(tokens: Column) -> Column:
    """Tokens as text, without blanks before closing and after opening punctuation."""
    joined = F.array_join(tokens, " ")
    return F.regexp_replace(F.regexp_replace(joined, r" ([,.;:!?)\]’'])", "$1"), r"([(\[]) ", "$1")


def expression_key(c: Column, label: Column) -> Column:
    """The key of a typed expression; empty ones have none."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "-", " "), " +", " "))
    return F.when(bare != "", F.concat(F.lit("mwe:"), bare, F.lit(":"), label))


def snippet(text: Column, start: Column, end: Column, around: int = 180) -> Column:
    """The text around [start, end), with runs of white space as one blank."""
    a = F.greatest(start - around, F.lit(0))
    b = F.least(end + around, F.length(text))
    return F.trim(F.regexp_replace(F.substring(text, a + 1, b - a), r"\s+", " "))


def highlighted(text: Column, forms: list[str], before: str = "<mark>", after: str = "</mark>") -> Column:
    """The text as HTML, with whole-word occurrences of the forms marked, the longest first, whatever their case."""
    import re

    safe = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    if not forms:
        return safe
    pattern = "|".join(re.escape(f) for f in sorted(forms, key=lambda f: (-len(f), f)))
    return F.regexp_replace(safe, rf"(?i)\b({pattern})\b", f"{before}$1{after}")


def sentence_span(tokens: Column, sentence: Column, least: int = 4) -> Column:
    """(start, end) of a sentence's tokens in a token array: all of them, else their longest beginning of at least `least`; null if none.

    Both are arrays of normalised tokens, given as columns of their own.
    """
    n = F.size(sentence)
    sizes = F.when(n >= least, F.reverse(F.sequence(F.lit(least), n))).otherwise(F.array(n))
    starts = F.when(F.size(tokens) > 0, F.sequence(F.lit(0), F.size(tokens) - 1)).otherwise(F.array().cast("array<int>"))
    place = lambda k: F.get(F.filter(starts, lambda s: F.slice(tokens, s + 1, k) == F.slice(sentence, F.lit(1), k)), F.lit(0))
    found = F.filter(F.transform(sizes, lambda k: F.struct(place(k).alias("start"), k.alias("k"))), lambda x: x["start"].isNotNull())
    best = F.get(found, F.lit(0))
    return F.when(best.isNotNull() & (n > 0), F.struct(best["start"].alias("start"), (best["start"] + best["k"]).alias("end")))
