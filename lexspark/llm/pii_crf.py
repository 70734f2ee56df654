"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field is trained from a small labelled table of sentences and adds
what the patterns miss: telephone numbers without a plus sign, addresses with a written-out at sign, IPv6.
It sees each word's shape and, of plain words beside it, the ending and a colon; numbers of several words
have states for their first and their further words, so that numbers side by side stay apart.

Plain words are those without digit, at sign or bracketed "at". Training checks that each of them, whatever its
shape, is so surely outside of personal data that no neighbours can outweigh it (see `Field.decided`). Every best path
then has O there, so texts fall into runs of other words, which Viterbi decodes exactly, in numpy batches
of runs of a length. Were the check to fail, lines would be decoded whole.

Very long texts are read whole, line by line. Null and empty texts have no spans. Repeated rows and ties are judged row by
row, an empty table gives an empty table, further columns are passed through untouched, whatever their names.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import struct_kernel

KINDS = ("email", "ip", "card", "phone")
#: Outside; the first word of each kind; further words of the kinds that have several.
STATES = ("O", *KINDS, "card+", "phone+")
KIND_OF = (None, 0, 1, 2, 3, 2, 3)
FIELDS = "n_email long, n_ip long, n_card long, n_phone long, n_added long, base string, spans string"

Span = tuple[int, int, int]  # kind, start, end

# ---- base spans

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}").finditer
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+").finditer
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").finditer
_DIGIT = re.compile(r"[0-9]").search


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """By kind, then start. Addresses grow from their at signs, so that long runs of letters cost nothing."""
    out: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN(text, at + 1)):
            end = m.end()
            out.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    if _DIGIT(text):
        out += [(1, *m.span()) for m in _IP(text) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m.group().split("."))]
        for m in _CARD(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


# ---- the labelled table

#: Sentences; {kind} stands for an item, # for a digit, * for a small letter, x for a hex digit.
SENTENCES = (
    "write to {email} today", "mail {email} or call {phone} now", "contact : {email}", "{email} wrote this", "from {email} to {email}",
    "call {phone} please", "call me at {phone} tonight", "phone {phone} , ask for ann", "tel . {phone} or fax {phone}", "phone: {phone}", "{phone}", "his number is {phone} and hers {phone}",
    "ring {phone} now", "call {phone}, {phone} or {phone}", "tel: {phone}, {phone}", "numbers : {phone} {phone}", "{phone} {phone}", "call {phone} {phone}", "list {phone} {phone} {phone}", "mobile {phone} , home {phone}", "reach us under {phone} or {phone} .",
    "ruf {phone} an", "appelez le {phone} demain", "llame al {phone} hoy", "telefon {phone} , fax: {phone}",
    "the host {ip} answered", "ping {ip} failed", "from {ip} to {ip} at night", "{ip} is down", "route via {ip} port ####",
    "paid with {card} in may", "card {card} was stolen", "{card} expires ##/##", "charge {card} or {card}", "cards {card}, {card}", "cards {card} {card} {card}", "the number {card} is mine",
    "version #.# of the code", "License , Version #.#.", "under CC BY-NC #.#.", "in #### there were ## of them", "on ####-##-## at ##:##",
    "born ##-##-#### at ##:##:##", "at ##:##:## on ##.##.####", "it took ##:##:##.### in all", "from ##:##:## to ##:##:##", "[##:##:##] done", "mac xx:xx:xx:xx:xx:xx here", "dates ##-##-#### , ##-##-####",
    "population # ### ### in ####", "a sum of ### ### ### euros", "about ## ### ### people", "pages ###-### and ###-###", "lines ### ### ### of it", "table # ## ### #### rows",
    "section #.#.# and page ###", "it cost ##.## or #,### or ###,###", "chapter ## , verse ##", "token = \"xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx\" here",
    "key AKIA####****#### there", "order ###### shipped", "id ########## of ##########", "only words are in this line", "a ratio of #/# or ##%", "see #### # ## ### words",
    "ref ####-#### and no ##-##", "room ### , floor #", "between #### and ####", "the ##th of may", "isbn ###-#-##-######-#", "isbn #-###-#####-#", "v#.#.##-rc# and build ####",
)
#: How the items are written.
ITEMS = {
    "email": ("****@****.***", "****.##@****#.*******.***", "***-***@*****.**", "****[at]*****.***", "****(at)*****.***", "*.****@***.****.***"),
    "ip": ("###.###.##.##", "##.#.#.#", "###.##.###.###", "xxxx:xxx::xxxx:xx:xxxx", "xxxx:xxxx:xxxx:xxxx:xxxx:xxxx:xxxx:xxxx", "fe80::xxxx:xxxx", "xxxx:xxx::xx"),
    "card": ("################", "#### #### #### ####", "####-####-####-####", "#### ###### #####"),
    "phone": (
        "+# (###) ###-####", "(###) ###-####", "###-###-####", "+## ### #######", "+## ## #### ####", "(0##) #### ####", "(###)###-####", "0### ### ####", "0## #### ####",
        "0#### ### ###", "### ### ####", "###.###.####", "0# ## ## ## ##", "0#-##-##-##-##", "0###-###-####", "(###) ### ####",
    ),
}


def labelled_sentences(copies: int = 6, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """The default labelled table: (words, states) of each sentence."""
    rng = random.Random(seed)

    def fill(s: str) -> str:
        s = re.sub("#", lambda _: rng.choice("0123456789"), s)
        s = re.sub(r"\*", lambda _: rng.choice("abcdefghijklmnopqrstuvwxyz"), s)
        return re.sub("x{2,}", lambda m: "".join(rng.choice("0123456789abcdef") for _ in m.group()), s)

    out = []
    for _ in range(copies):
        for sentence in SENTENCES:
            words: list[str] = []
            states: list[str] = []
            for part in sentence.split(" "):
                kind, tail = (part[1 : part.index("}")], part[part.index("}") + 1 :]) if part[:1] == "{" else ("O", "")
                own = fill(rng.choice(ITEMS[kind]) if kind != "O" else part).split(" ")
                if not tail and rng.random() < 0.15:
                    tail = rng.choice([",", ".", "!!", ";", "***"])
                own[-1] += tail
                words += own
                states += [kind] + [kind + "+" if kind + "+" in STATES else kind] * (len(own) - 1)
            out.append((words, states))
    return out


# ---- word shapes

_SHAPES = {c: "d" for c in range(48, 58)} | {c: "X" for c in range(65, 91)} | {c: "x" for c in range(97, 123)}
_AT_WORD = re.compile(r"[\[(]at[\])]")
_RUNS = re.compile(r"(.)\1+")
_TAIL = re.compile(r"[^A-Za-z0-9)\]]+$")


def shape_of(word: str) -> str:
    """Of a plain word W, its case, a mark of its length, and its ending (see cue_of); else its characters' classes."""
    if not (re.search("[0-9@]", word) or _AT_WORD.search(word)):
        case = "lower" if word.islower() else "upper" if word.isupper() else "title" if word[:1].isupper() else "other"
        return f"W {case} {min(len(word) // 3, 4)} {cue_of(word)}"
    tail = _TAIL.search(word)
    word = _TAIL.sub("", word)
    colons = "h" if word.count(":") >= 2 and re.fullmatch("[0-9a-f:]+", word) else ""
    shape = _AT_WORD.sub("@", word).translate(_SHAPES)
    if word[:1] == "0" or word[:2] == "(0":  # a leading zero begins numbers
        shape = shape.replace("d", "0", 1)
    return colons + shape + (" ," if tail and tail.group()[0] in ",;" else "")


def cue_of(word: str) -> str:
    """The last four letters, small, and whether a colon ends the word."""
    return "".join(c for c in word.lower() if c.isalpha())[-4:] + (":" if word.endswith(":") else "")


def plain_features(shape: str) -> list[str]:
    _, case, length, cue = shape.split(" ", 3)
    return ["W", "case=" + case, "length=" + length, "cue=" + cue]


def shape_features(shape: str, before: str = "", after: str = "") -> list[str]:
    """Of a word's shape, and of the cues of the plain words beside it ("^" at a line's ends, empty beside others)."""
    if shape[:2] == "W ":
        return plain_features(shape)
    around = [f"before={before}"] * bool(before) + [f"after={after}"] * bool(after)
    shape, comma, _ = shape.partition(" ,")
    digits = shape.count("d") + shape.count("0")
    out = around + [
        "bias", "squeezed=" + _RUNS.sub(r"\1", shape)[:40], f"digits={min(digits, 20)}", f"dots={min(shape.count('.'), 4)}", f"dashes={min(shape.count('-'), 4)}",
        "head=" + shape[:2], "tail=" + shape[-2:], f"at={'@' in shape}", f"letters={'x' in shape or 'X' in shape}", f"hex={shape[:1] == 'h'}", f"colons={min(shape.count(':'), 8)}:{'::' in shape}",
        f"long={min(len(shape) // 4, 10)}", f"only={digits == len(shape)}:{min(digits, 17)}", f"comma={bool(comma)}",
    ]
    if len(shape) <= 20:
        out.append("shape=" + shape)
    return out


Seen = tuple[str, str, str]  # a shape, and the cues before and after it


def seen_in(words: list[str]) -> list[Seen]:
    """What the field sees of each word of a line."""
    shapes = [shape_of(w) for w in words]
    plain = [s[:2] == "W " for s in shapes]
    cues = ["^", *(cue_of(w) if own else "" for w, own in zip(words, plain, strict=True)), "^"]
    return [(s, "", "") if own else (s, cues[k], cues[k + 2]) for k, (s, own) in enumerate(zip(shapes, plain, strict=True))]


# ---- the field


@dataclass
class Field:
    """Weights of features by state, and of transitions; sentences begin and end beside an O."""

    features: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray

    def emission(self, seen: Seen) -> np.ndarray:
        own = [self.features[f] for f in shape_features(*seen) if f in self.features]
        return self.weights[own].sum(axis=0) if own else np.zeros(len(STATES))

    def decided(self) -> bool:
        """Whether O is the state of every plain word, whatever its shape and its neighbours."""
        lead = self.weights[:, :1] - self.weights  # how far each feature prefers O
        least = lead[self.features["W"]].copy()
        for group in ("case=", "length=", "cue="):
            own = [k for f, k in self.features.items() if f.startswith(group)]
            least += np.minimum(lead[own].min(axis=0), 0) if own else 0
        m = self.moves
        gain = [max(m[a, y] + m[y, b] - m[a, 0] - m[0, b] for a in range(len(STATES)) for b in range(len(STATES))) for y in range(1, len(STATES))]
        return all(least[y] > gain[y - 1] for y in range(1, len(STATES)))

    def decode(self, emissions: np.ndarray) -> np.ndarray:
        """Best states (n, t) of n runs of t words, between words with state O."""
        n, t, s = emissions.shape
        best = self.moves[0] + emissions[:, 0]
        back = np.zeros((n, t, s), np.int8)
        for k in range(1, t):
            through = best[:, :, None] + self.moves
            back[:, k] = through.argmax(axis=1)
            best = through.max(axis=1) + emissions[:, k]
        state = (best + self.moves[:, 0]).argmax(axis=1)
        out = np.zeros((n, t), np.int8)
        for k in range(t - 1, -1, -1):
            out[:, k] = state
            state = back[np.arange(n), k, state]
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def train(sentences: list[tuple[list[str], list[str]]], steps: int = 140, rate: float = 0.15, ridge: float = 0.0004, move_ridge: float = 0.02) -> Field:
    """Maximum likelihood with ridges, by Adam over all sentences; words of the feature W alone pad the ends.

    The larger ridge on transitions leaves more to the words themselves, so that `decided` can hold.
    """
    shaped = [([shape_features(*x) for x in seen_in(w)], [STATES.index(y) for y in s]) for w, s in sentences]
    names = sorted({f for w, _ in shaped for x in w for f in x} | {"W"})
    index = {f: k for k, f in enumerate(names)}
    longest = max(len(w) for w, _ in shaped) + 2
    n, s = len(shaped), len(STATES)
    gold = np.zeros((n, longest), np.int64)
    active = np.zeros((n, longest, len(names)))
    active[:, :, index["W"]] = 1
    for i, (words, states) in enumerate(shaped):
        for k, (own, state) in enumerate(zip(words, states, strict=True), 1):
            active[i, k] = 0
            active[i, k, [index[f] for f in own]] = 1
            gold[i, k] = state
    hot = np.eye(s)[gold]
    flat = active.reshape(-1, len(names))
    field = Field(index, np.zeros((len(names), s)), np.zeros((s, s)))
    seen = flat.T @ hot.reshape(-1, s)
    moved = np.einsum("nta,ntb->ab", hot[:, :-1], hot[:, 1:])
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (field.weights, field.moves)]
    for step in range(1, steps + 1):
        e = (flat @ field.weights).reshape(n, longest, s)
        f = np.zeros_like(e)
        b = np.zeros_like(e)
        f[:, 0] = e[:, 0]
        for k in range(1, longest):
            f[:, k] = _log_sum(f[:, k - 1, :, None] + field.moves, 1) + e[:, k]
        for k in range(longest - 2, -1, -1):
            b[:, k] = _log_sum(field.moves + (e[:, k + 1] + b[:, k + 1])[:, None, :], 2)
        z = _log_sum(f[:, -1], 1)
        share = np.exp(f + b - z[:, None, None])
        pairs = np.exp(f[:, :-1, :, None] + field.moves + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]).sum(axis=(0, 1))
        slopes = ((seen - flat.T @ share.reshape(-1, s)) / n - ridge * field.weights, (moved - pairs) / n - move_ridge * field.moves)
        for p, g, m in zip((field.weights, field.moves), slopes, state, strict=True):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            p += rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    return field


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_sentences())


# ---- finding

_MAYBE = re.compile(r"[0-9@]|[\[(]at[\])]").search
_WORDS = re.compile(r"\S+").finditer
_GROUP = re.compile("[0-9A-Fa-f]{1,4}").fullmatch
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+(?:@|\[at\]|\(at\))[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").fullmatch
_PHONE_LIKE = re.compile(r"\+?[ ().0-9-]+").fullmatch


def is_ipv6(s: str) -> bool:
    """Eight groups of hex digits, or fewer with one "::", of which one group at least stands on each side, three in all."""
    head, gap, rest = s.partition("::")
    groups = [*head.split(":"), *(rest.split(":") if gap else [])]
    return all(map(_GROUP, groups)) and (3 <= len(groups) <= 7 if gap else len(groups) == 8)


def _sound(kind: int, s: str) -> bool:
    """The exact check of a decoded span."""
    digits = _digits(s)
    if kind == 0:
        return bool(_EMAIL(s))
    if kind == 1:
        parts = s.split(".")
        return is_ipv6(s) or len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return bool(_PHONE_LIKE(s)) and 9 <= len(digits) <= 15 and len(re.findall("[0-9]+", s)) >= 3


def _overlaps(taken: list[tuple[int, int]], span: Span) -> bool:
    """Whether a span overlaps any of the sorted taken ones (of kinds that may overlap each other)."""
    k = bisect_left(taken, (span[2], 0))
    return any(e > span[1] for _, e in taken[max(0, k - len(KINDS)) : k])


def _begins_anew(kind: int, number: str, first: str) -> bool:
    """Whether a word that begins with `first` can't belong to the number before it, or that one is complete."""
    digits = _digits(number)
    return number[-1] in ",;" or len(digits) >= (9 if first == "0" else 7) and first in "(+0" or kind == 2 and len(digits) == 16 and luhn(digits)


class Finder:
    def __init__(self, field: Field):
        self.field = field
        self.whole_lines = not field.decided()
        self.known: dict[Seen, np.ndarray] = {}

    def _emission(self, seen: Seen) -> np.ndarray:
        if seen not in self.known:
            if len(self.known) > 100_000:
                self.known = {}
            self.known[seen] = self.field.emission(seen)
        return self.known[seen]

    def _cue(self, word: str, side: str) -> str:
        """The cue of a plain word if the field knows it; empty of other words."""
        if _MAYBE(word):
            return ""
        cue = cue_of(word)
        return cue if side + cue in self.field.features else ""

    def _runs(self, text: str) -> list[list[tuple[int, int, Seen]]]:
        """Runs of neighbouring words, (start, end, what is seen), that have to be decoded."""
        out = []
        at = 0
        for line in text.split("\n"):
            if _MAYBE(line):
                words = [m.span() for m in _WORDS(line)]
                run: list[tuple[int, int, Seen]] = []
                for k, (a, b) in enumerate(words):
                    word = line[a:b]
                    maybe = _MAYBE(word)
                    if maybe or self.whole_lines:
                        before = self._cue(line[slice(*words[k - 1])], "before=") if k else "^"
                        after = self._cue(line[slice(*words[k + 1])], "after=") if k + 1 < len(words) else "^"
                        run.append((at + a, at + b, (shape_of(word), before, after) if maybe else (shape_of(word), "", "")))
                    elif run:
                        out.append(run)
                        run = []
                if run:
                    out.append(run)
            at += len(line) + 1
        return out

    def added(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """Spans beside the base ones of each text, decoded in batches of runs of a length."""
        by_length: dict[int, list[tuple[int, list]]] = {}
        for k, text in enumerate(texts):
            for run in self._runs(text):
                by_length.setdefault(len(run), []).append((k, run))
        out: list[list[Span]] = [[] for _ in texts]
        for length, own in by_length.items():
            step = max(1, 200_000 // length)
            for a in range(0, len(own), step):
                part = own[a : a + step]
                emissions = np.array([[self._emission(seen) for _, _, seen in run] for _, run in part])
                for (k, run), states in zip(part, self.field.decode(emissions), strict=True):
                    if states.any():
                        out[k] += self._spans(texts[k], run, states.tolist())
        for k, spans in enumerate(out):
            if spans:
                taken = sorted((s, e) for _, s, e in base[k])
                out[k] = [x for x in spans if not _overlaps(taken, x)]
        return out

    @staticmethod
    def _spans(text: str, run: list[tuple[int, int, Seen]], states: list[int]) -> list[Span]:
        out = []
        k = 0
        while k < len(run):
            kind = KIND_OF[states[k]]
            j = k
            while j + 1 < len(run) and states[j + 1] > len(KINDS) and KIND_OF[states[j + 1]] == kind:  # further words of the same number
                if _begins_anew(kind, text[run[k][0] : run[j][1]], text[run[j + 1][0]]):
                    break
                j += 1
            if kind is not None:
                start, end = run[k][0], run[j][1]
                while start < end and not (text[start].isalnum() and text[start].isascii() or text[start] in "+("):
                    start += 1
                while end > start and not (text[end - 1].isalnum() and text[end - 1].isascii() or text[end - 1] == ")" and kind == 3):
                    end -= 1
                if start < end and _sound(kind, text[start:end]):
                    out.append((kind, start, end))
            k = j + 1
        return out

    def find(self, texts: list) -> list[tuple[list[Span], list[Span]]]:
        """(base spans, all spans) of each text, each by kind, then start."""
        own = [t or "" for t in texts]
        base = [base_spans(t) for t in own]
        return [(b, sorted(b + more)) for b, more in zip(base, self.added(own, base), strict=True)]


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """text with each span's place taken by its kind; overlapping spans are one, of the kind that begins first."""
    out = []
    at = 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _find_kernel(field: Field) -> Callable[[], Callable[[list], dict]]:
    def build() -> Callable[[list], dict]:
        finder = Finder(field)

        def judge(texts: list) -> dict:
            found = finder.find(texts)
            out = {f"n_{k}": [sum(x[0] == i for x in b) for b, _ in found] for i, k in enumerate(KINDS)}
            return out | {"n_added": [len(a) - len(b) for b, a in found], "base": [written(b) for b, _ in found], "spans": [written(a) for _, a in found]}

        return judge

    return build


def _redact_kernel(field: Field) -> Callable[[], Callable[[list], dict]]:
    def build() -> Callable[[list], dict]:
        finder = Finder(field)
        return lambda texts: {"text": [None if t is None else redacted(t, spans) for t, (_, spans) in zip(texts, finder.find(texts), strict=True)]}

    return build


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """A row of FIELDS for each row of docs."""
    found = struct_kernel(_find_kernel(field or default_field()), FIELDS)(F.col(text_col))
    return docs.select(F.col(id_col), found.alias("f")).select(id_col, "f.*")


def redact_column(text: Column, field: Field | None = None) -> Column:
    """Texts with each span of personal data replaced by its kind in brackets; null stays null."""
    return struct_kernel(_redact_kernel(field or default_field()), "text string")(text)["text"]
