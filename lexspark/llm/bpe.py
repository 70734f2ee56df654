"""Byte-pair encoding of many words at once, for tokenizers whose words end with a mark.

The merges are run on all words of a length together: each round takes every word's best-ranked pair.
Texts outside the plain characters below, and very long words, go through the tokenizer itself.
"""

from __future__ import annotations

import gc
import json
import re
from itertools import chain

import numpy as np

#: Characters for which no normal form, case rule or white-space rule of Unicode needs a look:
#: printable ASCII, blanks, line ends, Latin letters up to U+024F, dashes, quotes and the euro sign.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-¬®-ɏ‐-‧‰-⁞€]*").fullmatch
#: The word pattern of the tokenizer within the plain characters.
_LETTER = "a-zªµºß-öø-ɏ"
_DIGIT = "0-9²³¹¼-¾"
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^\\s{_LETTER}{_DIGIT}]+").findall
_LONGEST = 48
_NONE = np.iinfo(np.int32).max


def _byte_symbols() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shift = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(shift)) for b in range(256)]


class WordBpe:
    """ids(texts): the ids of each text as little-endian 32-bit numbers, as the tokenizer gives them.

    The ids of the last cache_words to 2 * cache_words distinct words are kept.
    """

    def __init__(self, path: str, cache_words: int = 300_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t["content"] for t in spec["added_tokens"]]
        self.cache_words = cache_words
        self.words: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        symbols = _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int32)
        self.last = np.array([vocab[s + end] for s in symbols], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in merges], np.int64)
        self.bits = 18
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, np.int32)
        for rank, (key, at) in enumerate(zip(keys.tolist(), self._slot(keys).tolist(), strict=True)):
            while self.slots[at] not in (-1, key):
                at = (at + 1) & ((1 << self.bits) - 1)
            if self.slots[at] == -1:
                self.slots[at], self.ranks[at] = key, rank

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * 0x9E3779B1 >> 13) & ((1 << self.bits) - 1)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 16 | right
        at = self._slot(keys)
        rank = np.where((got := self.slots[at]) == keys, self.ranks[at], _NONE)
        todo = np.flatnonzero((got != keys) & (got != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            got, key = self.slots[at[todo]], keys[todo]
            hit = got == key
            rank[todo[hit]] = self.ranks[at[todo[hit]]]
            todo = todo[~hit & (got != -1)]
        return rank

    def _merge(self, words: list[bytes], size: int, put) -> None:
        """put(number of the word, its ids) for all words, each of `size` bytes."""
        raw = np.frombuffer(b"".join(words), np.uint8).reshape(-1, size)
        token = self.inner[raw]
        token[:, -1] = self.last[raw[:, -1]]
        number = np.arange(len(words))
        rank = self._rank(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(len(words), size - 1)
        while True:
            width = token.shape[1]
            if width > 1:
                at = rank.argmin(axis=1)
                best = np.take_along_axis(rank, at[:, None], 1)[:, 0]
                done = best == _NONE
            else:
                done = np.ones(len(token), bool)
            if done.any():
                out = token[done].astype("<u4").tobytes()
                for k, n in enumerate(number[done].tolist()):
                    put(n, out[4 * width * k : 4 * width * (k + 1)])
                if done.all():
                    return
                more = ~done
                token, rank, number, at, best = token[more], rank[more], number[more], at[more], best[more]
            rows = np.arange(len(token))
            token[rows, at] = self.merged[best]
            cols = np.arange(width - 1)[None, :]
            token = np.take_along_axis(token, cols + (cols > at[:, None]), 1)
            if width > 2:
                cols = cols[:, :-1]
                rank = np.take_along_axis(rank, cols + (cols >= at[:, None]), 1)
                own = np.flatnonzero(at < width - 2)
                rank[own, at[own]] = self._rank(token[own, at[own]], token[own, at[own] + 1])
                own = np.flatnonzero(at > 0)
                rank[own, at[own] - 1] = self._rank(token[own, at[own] - 1], token[own, at[own]])

    def _learn(self, words: list[str]) -> None:
        by_size: dict[int, list[str]] = {}
        for w in words:
            by_size.setdefault(len(w) if w.isascii() else len(w.encode()), []).append(w)
        known = self.words
        for size, own in by_size.items():
            if size > _LONGEST:
                for w, e in zip(own, self.tokenizer.encode_batch_fast(own, add_special_tokens=False), strict=True):
                    known[w] = np.array(e.ids, "<u4").tobytes()
            else:
                self._merge([w.encode() for w in own], size, lambda n, ids, own=own: known.__setitem__(own[n], ids))

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. The words of plain texts are encoded once and kept; other texts are encoded whole."""
        collecting = gc.isenabled()
        gc.disable()  # nothing here is cyclic, and each pass would walk the caches
        try:
            plain = [bool(_PLAIN(t)) and not ("<|" in t and any(m in t for m in self.marks)) for t in texts]
            parts = [_WORD(t.lower()) if own else [] for t, own in zip(texts, plain, strict=True)]
            missing = set(chain.from_iterable(parts))
            missing.difference_update(self.words)
            if missing:
                if len(self.words) + len(missing) > self.cache_words:
                    self.before, self.words = self.words, {}
                    missing = set(chain.from_iterable(parts))
                again = [w for w in missing if w in self.before]
                self.words.update(zip(again, map(self.before.__getitem__, again), strict=True))
                missing.difference_update(again)
                self._learn(list(missing))
            found = self.words.__getitem__
            out = [b"".join(map(found, p)) for p in parts]
            for k in [k for k, own in enumerate(plain) if not own]:
                out[k] = np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, "<u4").tobytes()
            return out
        finally:
            if collecting:
                gc.enable()
