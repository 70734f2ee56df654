"""Senses of words and expressions, decided and counted where a text is read: only counts are shuffled, never occurrences."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import lexspark
from lexspark.operators.analyse import LEXICON_POS
from lexspark.operators.grams import _choose
from lexspark.operators.senses import LOW_CONFIDENCE
from lexspark.operators.tokens import STOP

cloudpickle.register_pickle_by_value(lexspark)  # kernels travel with their tasks

Types = list[tuple[str, str]]


@dataclass(frozen=True)
class Rules:
    """What a task asks in place of the tables forms, candidates and arbitration.

    `form` gives lemma and part of speech of a lower-case form, None for an unknown one; `senses` how many senses a (word, pos) has,
    numbered from 1. `scores` gives gloss and French scores of a matrix with a row for each (segment, type) and a column for each
    sense: it gets the segments (m, 1), the rows' types, the places of these among all types, and the senses (1, k). `answers` gives for
    segments, places and types the sense chosen (0: none fits, -1: no answer) and its confidence.
    """

    form: Callable[[str], tuple[str, str] | None]
    senses: Callable[[str, str], int]
    scores: Callable[[np.ndarray, np.ndarray, Types, np.ndarray], tuple[np.ndarray, np.ndarray]]
    answers: Callable[[np.ndarray, np.ndarray, Types], tuple[np.ndarray, np.ndarray]]


#: Bytes of text worked on at once.
UNIT_BYTES = 8 << 20
#: kind is word (of a lemma; n is 0 where it is only seen), sense (place: its number, 0 if none fits), expression (word: the expression) or segment (a single one of a sense).
ROW = "kind string, word string, pos string, place int, n long, dispersion long, named long, review long, segment long, surface string"
_FIELDS = pa.schema([("kind", pa.string()), ("word", pa.string()), ("pos", pa.string()), ("place", pa.int32()), *[(c, pa.int64()) for c in ("n", "dispersion", "named", "review", "segment")], ("surface", pa.string())])
#: Every ASCII byte that is no letter or digit is a blank; other bytes stay.
_BYTES = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets of the rows' words, words): runs of letters and digits. A row without words may have an empty one."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    other = pc.invert(pc.string_is_ascii(texts))
    if pc.any(other).as_py():
        texts = pc.replace_with_mask(texts, other, pc.replace_substring_regex(texts.filter(other), r"[^\p{L}\p{N}]+", " "))
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = _BYTES[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]]
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(data))
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(plain))
    return words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py(), words.flatten().cast(pa.string())


class Expressions:
    """Expressions of two words or more by their beginnings: of each length the sorted (beginning before, word), and the expression that ends there."""

    def __init__(self, idioms: list[str]):
        self.idioms = sorted({i for i in idioms if i and len(i.split(" ")) > 1})
        parted = [i.split(" ") for i in self.idioms]
        self.words = sorted({w for i in parted for w in i})
        number = {w: k for k, w in enumerate(self.words)}
        now = {(number[w],): number[w] for w in self.words}
        self.keys, self.ends = [], []
        for n in range(2, max(map(len, parted), default=1) + 1):
            begun = sorted({tuple(number[w] for w in i[:n]) for i in parted if len(i) >= n}, key=lambda b: (now[b[:-1]], b[-1]))
            self.keys.append(np.array([now[b[:-1]] << 32 | b[-1] for b in begun], np.int64))
            now = {b: k for k, b in enumerate(begun)}
            ends = np.full(len(begun), -1)
            for k, i in enumerate(parted):
                if len(i) == n:
                    ends[now[tuple(number[w] for w in i)]] = k
            self.ends.append(ends)

    def places(self, ids: np.ndarray, row: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For 2, 3, ... words the places where expressions begin, within a row, and at each place the expression or -1. ids: the words' numbers, -1 unknown."""
        starts, found, now = [], [], ids
        for n, (keys, ends) in enumerate(zip(self.keys, self.ends, strict=True), 2):
            m = max(0, len(ids) - n + 1)
            at = np.flatnonzero((now[:m] >= 0) & (ids[n - 1 :] >= 0) & (row[:m] == row[n - 1 :]))
            asked = now[at] << 32 | ids[at + n - 1]
            p = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            at, p = at[keys[p] == asked], p[keys[p] == asked]
            now = np.full(m, -1)
            now[at] = p
            idiom = np.full(m, -1)
            idiom[at] = ends[p]
            starts.append(np.flatnonzero(idiom >= 0))
            found.append(idiom)
        return starts, found


def decide(gloss: np.ndarray, french: np.ndarray, chosen: np.ndarray, confidence: np.ndarray, low: float = 0.15) -> tuple[np.ndarray, np.ndarray]:
    """(sense from 1 or 0 for none, to be looked at) of rows of scores, a column for each sense: as `senses.analyse_occurrences`."""
    final, k = gloss + french, gloss.shape[1]
    each, top = np.arange(len(final)), final.argmax(1)
    rest = final.copy()
    rest[each, top] = -np.inf
    margin = final[each, top] - rest.max(1) if k > 1 else np.ones(len(final))
    best = [np.where(x != 0, x, -np.inf).argmax(1) for x in (gloss, french)]
    disagree = (gloss != 0).any(1) & (french != 0).any(1) & (best[0] != best[1])
    asked = (margin < low) | (final == 0).all(1) | disagree
    usable, none = asked & (chosen >= 1) & (chosen <= k), asked & (chosen == 0)
    return np.where(usable, chosen, np.where(none, 0, top + 1)), asked & (~usable | (confidence < LOW_CONFIDENCE))


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def _rows(kind: str, size: int, **columns: pa.Array | np.ndarray) -> pa.RecordBatch:
    given = columns | {"kind": pa.repeat(kind, size)}
    made = {c: x if isinstance(x, pa.Array) else pa.array(x) for c, x in given.items()}
    return pa.RecordBatch.from_arrays([made[f.name].cast(f.type) if f.name in made else pa.nulls(size, f.type) for f in _FIELDS], schema=_FIELDS)


def _unit(told: pa.Table, rules: Rules, known: Expressions, wanted: set | None) -> Iterator[pa.RecordBatch]:
    segment = told["segment"].to_numpy()
    if (np.diff(segment) < 0).any():  # the first occurrence is that of the smallest segment
        order = np.argsort(segment, kind="stable")
        told, segment = told.take(order), segment[order]
    offsets, words = _words(told["en"].combine_chunks())
    row = np.repeat(np.arange(len(told)), np.diff(offsets))
    inside = np.asarray(told["analysed"].combine_chunks().to_numpy(zero_copy_only=False), bool)[row]

    coded = words.dictionary_encode()
    surfaces, at = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    order = pc.array_sort_indices(surfaces)
    surfaces = surfaces.take(order)
    lower = pc.utf8_lower(surfaces)
    types: dict[tuple[str, str], int] = {}
    kind, content, named = np.full(len(surfaces), -1), np.zeros(len(surfaces), bool), np.zeros(len(surfaces), np.int64)
    for k, (surface, form) in enumerate(zip(surfaces.to_pylist(), lower.to_pylist(), strict=True)):
        lemma, upos = rules.form(form) or (form, "X")
        pos = LEXICON_POS.get(upos)
        if pos is not None:
            lemma = lemma.lower()
            kind[k] = types.setdefault((lemma, pos), len(types))
            content[k] = surface.isalpha() and form not in STOP and len(lemma) >= 3
            named[k] = upos == "PROPN"
    by_kind = np.argsort(kind, kind="stable")  # spellings of a type side by side, in order
    surfaces, lower, kind, content, named = surfaces.take(by_kind), lower.take(by_kind), kind[by_kind], content[by_kind], named[by_kind]
    place = np.empty(len(kind), np.int64)
    place[order.to_numpy()[by_kind]] = np.arange(len(kind))
    at = place[at]

    numbers = pc.fill_null(pc.index_in(lower, value_set=pa.array(known.words, pa.string())), -1).to_numpy().astype(np.int64)
    starts, found = known.places(np.where(inside, numbers[at], -1), row)
    covered, spans = np.zeros(len(at), bool), [np.zeros((2, 0), np.int64)]
    for n, chosen in _choose(starts, len(at)):
        for k in range(n):
            covered[chosen + k] = True
        if len(chosen):
            spans.append(np.stack([found[n - 2][chosen], row[chosen]]))

    free = inside & content[at] & ~covered
    key = np.sort(row[free] * len(kind) + at[free])
    r, q = np.divmod(key, max(1, len(kind)))
    first = _starts(r, kind[q])
    count = np.diff(first, append=len(key))
    names = np.add.reduceat(named[q], first) if len(first) else count
    pair, spelt, where = kind[q[first]], q[first], segment[r[first]]  # of each (segment, type): the type, its first spelling, the segment
    all_types = list(types)
    sense, review = np.full(len(pair), -1), np.zeros(len(pair), bool)
    sizes = np.array([rules.senses(*t) for t in all_types], np.int64)
    for k in np.unique(sizes[pair]).tolist():
        if k > 0:
            here = np.flatnonzero(sizes[pair] == k)
            scores = [np.broadcast_to(x, (len(here), k)).astype(float) for x in rules.scores(where[here][:, None], pair[here], all_types, np.arange(1, k + 1)[None])]
            sense[here], review[here] = decide(*scores, *rules.answers(where[here], pair[here], all_types))

    word, pos = (pa.array([t[c] for t in all_types], pa.string()) for c in (0, 1))
    if wanted is None:
        total, seen, marked = (np.bincount(pair, w, len(all_types)).astype(np.int64) for w in (count, None, names))
        yield _rows("word", len(all_types), word=word, pos=pos, n=total, dispersion=seen, named=marked)
        idiom, line = np.concatenate(spans, axis=1)
        order = np.lexsort((line, idiom))
        idiom, line = idiom[order], line[order]
        each = _starts(idiom, line)
        per = _starts(idiom[each])
        ids = idiom[each][per]
        yield _rows("expression", len(ids), word=pa.array(known.idioms, pa.string()).take(pa.array(ids)), n=np.bincount(idiom, minlength=1)[ids], dispersion=np.diff(per, append=len(each)))
    decided = np.flatnonzero(sense >= 0)
    key = pair[decided] * (max(sizes.tolist(), default=0) + 1) + sense[decided]
    decided = decided[np.argsort(key, kind="stable")]  # segments stay in order
    first = _starts(pair[decided], sense[decided])
    one = decided[first]
    if wanted is not None:
        asked = np.array([(*all_types[t], s) in wanted for t, s in zip(pair[one].tolist(), sense[one].tolist(), strict=True)], bool)
        few = decided[np.repeat(asked, np.diff(first, append=len(decided)))]
        yield _rows("segment", len(few), word=word.take(pa.array(pair[few])), pos=pos.take(pa.array(pair[few])), place=sense[few], segment=where[few])
    elif len(one):
        sums = lambda x: np.add.reduceat(x[decided], first)
        yield _rows(
            "sense", len(one), word=word.take(pa.array(pair[one])), pos=pos.take(pa.array(pair[one])), place=sense[one], n=sums(count), dispersion=np.diff(first, append=len(decided)), review=sums(count * review),
            segment=where[one], surface=surfaces.take(pa.array(spelt[one])),
        )


def _count(rules: Rules, known: Broadcast, wanted: set | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expressions, held, size = Expressions(known.value), [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= UNIT_BYTES:
                yield from _unit(pa.Table.from_batches(held), rules, expressions, wanted)
                held, size = [], 0
        if held:
            yield from _unit(pa.Table.from_batches(held), rules, expressions, wanted)

    return run


def parts(segments: DataFrame, rules: Rules, expressions: list[str], wanted: set | None = None) -> DataFrame:
    """ROW of parts of segments (segment, kind, en); what one segment has is all in one part. With `wanted`, the segments of those (word, pos, place) alone.

    Expressions go to every task; they are a lexicon, which doesn't grow with the texts.
    """
    known = segments.sparkSession.sparkContext.broadcast(expressions)
    told = segments.select("segment", "en", (F.col("kind") != "hors_oeuvre").alias("analysed"))
    return told.mapInArrow(_count(rules, known, wanted), ROW)


def summed(rows: DataFrame) -> DataFrame:
    """A row for each (kind, word, pos, place); segment and surface of the first occurrence."""
    first = F.min(F.when(F.col("segment").isNotNull(), F.struct("segment", "surface"))).alias("first")
    per = rows.groupBy("kind", "word", "pos", "place").agg(*[F.sum(c).alias(c) for c in ("n", "dispersion", "named", "review")], first)
    return per.select("kind", "word", "pos", "place", "n", "dispersion", "named", "review", "first.segment", "first.surface")
