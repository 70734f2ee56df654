"""A French stemmer after the published Snowball description."""

from __future__ import annotations

import re

_VOWELS = "aeiouyâàëéêèïîôûù"
#: Suffixes of the standard and verb steps, from the published description.
_S1 = ("ance", "iqUe", "isme", "able", "iste", "eux", "ances", "iqUes", "ismes", "ables", "istes")
_S2 = ("atrice", "ateur", "ation", "atrices", "ateurs", "ations")
_S3 = ("logie", "logies")
_S4 = ("usion", "ution", "usions", "utions")
_S5 = ("ence", "ences")
_S6 = ("ement", "ements")
_S7 = ("ité", "ités")
_S8 = ("if", "ive", "ifs", "ives")
_I_VERBS = (
    "îmes", "ît", "îtes", "i", "ie", "ies", "ir", "ira", "irai", "iraIent", "irais", "irait", "iras", "irent", "irez", "iriez", "irions", "irons", "iront", "is",
    "issaIent", "issais", "issait", "issant", "issante", "issantes", "issants", "isse", "issent", "isses", "issez", "issiez", "issions", "issons", "it",
)
_E_VERBS = ("é", "ée", "ées", "és", "èrent", "er", "era", "erai", "eraIent", "erais", "erait", "eras", "erez", "eriez", "erions", "erons", "eront", "ez", "iez")
_A_VERBS = ("âmes", "ât", "âtes", "a", "ai", "aIent", "ais", "ait", "ant", "ante", "antes", "ants", "as", "asse", "assent", "asses", "assiez", "assions")


def _longest(word: str, suffixes: tuple[str, ...]) -> str:
    return max((s for s in suffixes if word.endswith(s)), key=len, default="")


def _regions(word: str) -> tuple[int, int, int]:
    """Where RV, R1 and R2 begin."""
    n = len(word)
    vowel = [c in _VOWELS for c in word]
    if word[:3] in ("par", "col", "tap") or n > 1 and vowel[0] and vowel[1]:
        rv = min(3, n)
    else:
        rv = next((k + 1 for k in range(1, n) if vowel[k]), n)

    def after(start: int) -> int:
        return next((k + 1 for k in range(start + 1, n) if not vowel[k] and vowel[k - 1]), n)

    r1 = after(0)
    return rv, r1, after(r1)


def stem(word: str) -> str:
    w = word.lower()
    w = re.sub(f"(?<=[{_VOWELS}])([ui])(?=[{_VOWELS}])", lambda m: m.group(1).upper(), w)
    w = re.sub(f"(?<=[{_VOWELS}])y|y(?=[{_VOWELS}])", "Y", w)
    w = w.replace("qu", "qU")
    rv, r1, r2 = _regions(w)
    before = w
    special = False  # amment, emment, ment, ments ask for the verb step too

    def within(s: str, region: int) -> bool:
        return len(w) - len(s) >= region

    s = _longest(w, (*_S1, *_S2, *_S3, *_S4, *_S5, *_S6, *_S7, *_S8, "euse", "euses", "issement", "issements", "amment", "emment", "ment", "ments", "eaux", "aux"))
    if s in _S1 and within(s, r2):
        w = w[: -len(s)]
    elif s in _S2 and within(s, r2):
        w = w[: -len(s)]
        if w.endswith("ic"):
            w = w[:-2] if len(w) - 2 >= r2 else w[:-2] + "iqU"
    elif s in _S3 and within(s, r2):
        w = w[: -len(s)] + "log"
    elif s in _S4 and within(s, r2):
        w = w[: -len(s)] + "u"
    elif s in _S5 and within(s, r2):
        w = w[: -len(s)] + "ent"
    elif s in _S6 and within(s, rv):
        w = w[: -len(s)]
        if w.endswith("iv") and len(w) - 2 >= r2:
            w = w[:-2]
            if w.endswith("at") and len(w) - 2 >= r2:
                w = w[:-2]
        elif w.endswith("eus"):
            w = w[:-3] if len(w) - 3 >= r2 else w[:-1] + "x" if len(w) - 3 >= r1 else w
        elif w.endswith(("abl", "iqU")) and len(w) - 3 >= r2:
            w = w[:-3]
        elif w.endswith(("ièr", "Ièr")) and len(w) - 3 >= rv:
            w = w[:-3] + "i"
    elif s in _S7 and within(s, r2):
        w = w[: -len(s)]
        if w.endswith("abil"):
            w = w[:-4] if len(w) - 4 >= r2 else w[:-2] + "l"
        elif w.endswith("ic"):
            w = w[:-2] if len(w) - 2 >= r2 else w[:-2] + "iqU"
        elif w.endswith("iv") and len(w) - 2 >= r2:
            w = w[:-2]
    elif s in _S8 and within(s, r2):
        w = w[: -len(s)]
        if w.endswith("at") and len(w) - 2 >= r2:
            w = w[:-2]
            if w.endswith("ic"):
                w = w[:-2] if len(w) - 2 >= r2 else w[:-2] + "iqU"
    elif s in ("euse", "euses") and within(s, r1):
        w = w[: -len(s)] + ("" if within(s, r2) else "eux")
    elif s in ("issement", "issements") and within(s, r1) and w[: -len(s)][-1:] not in _VOWELS:
        w = w[: -len(s)]
    elif s in ("amment", "emment") and within(s, rv):
        w, special = w[: -len(s)] + ("ant" if s[0] == "a" else "ent"), True
    elif s in ("ment", "ments") and w[: -len(s)][-1:] in _VOWELS and len(w) - len(s) - 1 >= rv:
        w, special = w[: -len(s)], True
    elif s == "eaux":
        w = w[:-1]
    elif s == "aux" and within(s, r1):
        w = w[:-2] + "l"

    if w == before or special:
        at_start = w
        s = _longest(w[rv:], _I_VERBS)
        if s and len(w) - len(s) - 1 >= rv and w[-len(s) - 1] not in _VOWELS:
            w = w[: -len(s)]
        if w == at_start:
            s = _longest(w[rv:], ("ions", *_E_VERBS, *_A_VERBS))
            if s == "ions":
                w = w[:-4] if within(s, r2) else w
            elif s in _E_VERBS:
                w = w[: -len(s)]
            elif s:
                w = w[: -len(s)]
                if len(w) - 1 >= rv and w.endswith("e"):
                    w = w[:-1]
        changed = w != at_start or w != before
    else:
        changed = True
    if changed:
        if w.endswith("Y"):
            w = w[:-1] + "i"
        elif w.endswith("ç"):
            w = w[:-1] + "c"
    else:
        if w.endswith("s") and len(w) > 1 and w[-2] not in "aiouès":
            w = w[:-1]
        tail = w[rv:]
        if tail.endswith("ion") and len(w) - 3 >= r2 and len(w) - 4 >= rv and w[-4] in "st":
            w = w[:-3]
        elif s := _longest(tail, ("ier", "ière", "Ier", "Ière")):
            w = w[: -len(s)] + "i"
        elif tail.endswith("e"):
            w = w[:-1]
        elif tail.endswith("ë") and w[:-1].endswith("gu"):
            w = w[:-1]
    if w.endswith(("enn", "onn", "ett", "ell", "eill")):
        w = w[:-1]
    w = re.sub(f"[éè]([^{_VOWELS}]+)$", r"e\1", w)
    return w.replace("I", "i").replace("U", "u").replace("Y", "y")
