"""Quality rules: compression bands.

Zstandard ratios (compressed size over raw size) of the whole text and of fixed chunks are held against
limits for the text's length; the last chunk ends at the text's end, overlapping the one before where the
length isn't a multiple. Short texts have shorter chunks, and the shortest are one chunk as a whole, so every byte of
a text that has limits is in a chunk, however long the text. Below its band a text is repetitive, above it is incompressible.

Nulls and empty texts have no words and fail the base rule. Repeated rows and ties are judged row by row,
an empty table gives an empty table, further columns are passed through untouched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import struct_kernel

SYMBOLS = "#*$%&|<>"
SEPARATORS = " \t\n\x0b\x0c\r"
WINDOW = 5
FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "ratio double, n_chunks long, n_odd_chunks long, base_failed boolean, kept boolean"
)


@dataclass(frozen=True)
class Bands:
    """Limits by length: (shortest text in UTF-8 bytes, lowest ratio, highest ratio), and for chunks
    (shortest text, bytes of a chunk, lowest ratio, highest ratio).

    Texts shorter than the first entry have no limits: the frame of a compressed block outweighs them. Texts
    shorter than the first entry for chunks are one chunk, with the limits of the whole.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (128, 0.22, 1.05),
        (256, 0.34, 0.92),
        (512, 0.34, 0.84),
        (1024, 0.30, 0.76),
        (4096, 0.26, 0.70),
        (16384, 0.22, 0.66),
    )
    chunks: tuple[tuple[int, int, float, float], ...] = ((512, 512, 0.34, 0.84), (2048, 2048, 0.24, 0.74))
    odd_chunk_share: float = 0.3
    level: int = 3
    min_words: int = 10
    max_repeat_percent: int = 20


def repeated_words(words: list[bytes]) -> int:
    """Words inside any window of WINDOW words that the text has twice or more."""
    n = len(words)
    if n <= WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    base = len(ids)
    if base == n:
        return 0
    if base**WINDOW < 2**63:
        key = code[: n - WINDOW + 1].copy()
        for k in range(1, WINDOW):
            key = key * base + code[k : n - WINDOW + 1 + k]
    else:  # ranks keep the numbers small and the comparison exact
        pair = np.unique(code[:-1] * base + code[1:], return_inverse=True)[1]
        four = np.unique(pair[:-2] * np.int64(n) + pair[2:], return_inverse=True)[1]
        key = four[: n - WINDOW + 1] * np.int64(base) + code[WINDOW - 1 :]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    inside = np.zeros(n, bool)
    for k in range(WINDOW):
        inside[k : k + len(key)] |= again
    return int(inside.sum())


def duplicate_lines(raw: bytes) -> int:
    seen: set[bytes] = set()
    repeats = 0
    for line in raw.split(b"\n"):
        if line.strip():
            if line in seen:
                repeats += 1
            else:
                seen.add(line)
    return repeats


def kernel(bands: Bands) -> Callable[[], Callable[[list], dict]]:
    def build() -> Callable[[list], dict]:
        compress = zstandard.ZstdCompressor(level=bands.level).compress
        names = [field.split()[0] for field in FIELDS.split(", ")]

        def judge(text: str | None) -> tuple:
            text = text or ""
            raw = text.encode("utf-8", "surrogatepass")
            words = raw.split()
            n = len(words)
            chars = len(text) - sum(map(text.count, SEPARATORS))
            symbols = sum(map(text.count, SYMBOLS))
            repeats = repeated_words(words)
            ratio = len(compress(raw)) / len(raw) if raw else 0.0
            low, high = next(((lo, hi) for least, lo, hi in reversed(bands.whole) if len(raw) >= least), (0.0, float("inf")))
            size, chunk_low, chunk_high = next((own for least, *own in reversed(bands.chunks) if len(raw) >= least), (len(raw), low, high))
            starts = []
            if raw and len(raw) >= bands.whole[0][0]:
                starts = [*range(0, len(raw) - size + 1, size)]
                if len(raw) % size:
                    starts.append(len(raw) - size)
            odd = sum(not chunk_low <= len(compress(raw[a : a + size])) / size <= chunk_high for a in starts)
            failed = n < bands.min_words or 100 * repeats > bands.max_repeat_percent * n
            kept = not failed and low <= ratio <= high and odd <= bands.odd_chunk_share * len(starts)
            return n, chars, symbols, duplicate_lines(raw), repeats, ratio, len(starts), odd, failed, kept

        return lambda texts: dict(zip(names, zip(*map(judge, texts)), strict=True))

    return build


def quality_column(text: Column, bands: Bands = Bands()) -> Column:
    """The struct of FIELDS for a column of texts."""
    return struct_kernel(kernel(bands), FIELDS)(text)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """A row of FIELDS for each row of docs."""
    return docs.select(F.col(id_col), quality_column(F.col(text_col), bands).alias("q")).select(id_col, "q.*")
