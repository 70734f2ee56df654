"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are fitted on the driver from at most MAX_TRAIN_ROWS labelled documents, those with the smallest
hashes of their ids among the rows that may be learned from; only their statistics are gathered. Scoring
covers all documents, in batches.

Very long texts are read whole. Null texts count as empty; both get the score that their statistics (all zero) lead to. A doc_id with
several labels counts once, with the largest; labels that are null are left out. Without labels, or with
labels of one kind, every score is that kind's share, held within 0.001 and 0.999. Repeated documents are
scored row by row, an empty table gives an empty table, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import struct_kernel
from lexspark.llm.quality_bands import duplicate_lines, repeated_words
from lexspark.llm.trees import Forest, fit

#: Most labelled documents that the trees are fitted on.
MAX_TRAIN_ROWS = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
NAMES = (
    "bytes", "words", "mean_word", "long_words", "short_words", "lower", "upper", "digit", "space", "punctuation", "symbol", "beyond_ascii",
    "lines", "mean_line", "duplicate_lines", "distinct_words", "top_word", "repeated_words", "symbol_ends", "capital_words", "ratio", "entropy", "stops", "bars",
)
_CLASS = np.zeros(256, np.int64)
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r", b".,;:!?'\"()-", b"#*$%&|<>=+/\\_~^@[]{}`", bytes(range(128, 256)))):
    _CLASS[list(_chars)] = _k + 1


def statistics_kernel() -> Callable[[list], np.ndarray]:
    compress = zstandard.ZstdCompressor(level=1).compress

    def one(text: str | None) -> list[float]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if not raw:
            return [0.0] * len(NAMES)
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        share = np.bincount(_CLASS, counts, 8)[1:] / len(raw)
        p = counts[counts > 0] / len(raw)
        words = raw.split()
        n = max(len(words), 1)
        length = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
        tally: dict[bytes, int] = {}
        for w in words:
            tally[w] = tally.get(w, 0) + 1
        lines = raw.count(b"\n") + 1
        ends = sum(v for w, v in tally.items() if w[-1] in b"#*$%&|<>!=")
        capital = sum(v for w, v in tally.items() if len(w) > 1 and w.isupper())
        return [
            np.log1p(len(raw)), np.log1p(len(words)), length.mean(), (length > 15).mean(), (length < 3).mean(), *share,
            lines / n, len(raw) / lines, duplicate_lines(raw) / lines, len(tally) / n, max(tally.values(), default=0) / n, repeated_words(words) / n,
            ends / n, capital / n, len(compress(raw)) / len(raw), -(p * np.log2(p)).sum(), raw.count(b".") / n, raw.count(b"|") / n,
        ]

    return lambda texts: np.array([one(t) for t in texts], np.float64).reshape(len(texts), len(NAMES))


def statistics_column(text: Column) -> Column:
    def build() -> Callable[[list], dict]:
        kernel = statistics_kernel()
        return lambda texts: {"x": list(kernel(texts))}

    return struct_kernel(build, "x array<double>")(text)["x"]


def fold(id_col: Column, folds: int) -> Column:
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(folds))


def training_labels(labels: DataFrame, label: str, folds: int, held_out: int, id_col: str = "doc_id", limit: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(id, label) of at most `limit` labelled ids outside of the held-out fold, by the ids' hashes."""
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (fold(F.col(id_col), folds) != held_out))
    one = usable.groupBy(F.col(id_col).alias("__id")).agg(F.max(label).cast("int").alias("__label"))
    return one.orderBy(F.xxhash64("__id"), "__id").limit(limit)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = MAX_TRAIN_ROWS) -> Forest:
    chosen = training_labels(labels, "quality", FOLDS, HELD_OUT, id_col, limit)
    own = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(chosen), "__id")  # limit rows at most
    rows = own.select("__id", "__label", statistics_column(F.col("__text")).alias("x")).dropDuplicates(["__id"]).collect()
    rows.sort(key=lambda r: r["__id"])
    x = np.array([r.x for r in rows], np.float64).reshape(len(rows), len(NAMES))
    return fit(x, np.array([r["__label"] for r in rows], np.float64))


def score_quality(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def build() -> Callable[[list], dict]:
        kernel = statistics_kernel()
        return lambda texts: {"score": forest.predict(kernel(texts))}

    score = struct_kernel(build, "score double")(F.col(text_col))["score"]
    scored = docs.select(F.col(id_col), score.alias("score"))
    return scored.select(
        F.col(id_col),
        F.coalesce(fold(F.col(id_col), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def quality_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted for each row of docs."""
    return score_quality(docs, fit_quality(docs, labels, id_col, text_col), id_col, text_col)
