"""Toxicity: non-negative positive-unlabelled learning.

Only confirmed toxic documents are labels here; clean labels are used for nothing but the class prior. A
linear classifier on hashes of words and word beginnings minimises the non-negative estimate of the classification risk,
  prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)),
whose second part, the risk on the unseen negatives, is not let below zero.

Features are chosen by counts over all data: in how many of the positive documents, and of all documents
outside the held-out fold, each occurs. The classifier is then fitted on the driver from samples of documented size,
MAX_POSITIVE toxic and MAX_UNLABELLED other documents, by the smallest hashes of their ids, of which only
the chosen features are gathered. Scoring covers all documents.

A text that makes up more than a HOT_SHARE of the unlabelled documents counts once there, however many copies it has.

Null texts count as empty; both have no words and get the score of the intercept. Very long texts are read whole; each
feature counts once. A doc_id with several labels is toxic if any says so; null labels are left out. Without toxic labels
every score is zero. Repeated documents (ties) are scored row by row, an empty table gives an empty table, further columns
are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import arrow_fields, checkpointed, slices, struct_kernel
from lexspark.llm.quality_gbdt import fold

MAX_POSITIVE = 3_000
MAX_UNLABELLED = 12_000
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: Lengths of the word beginnings that are features, in bytes.
BEGINNINGS = (4, 5, 6, 7, 8)
#: A feature is used if that many positive documents have it, so much more often than unlabelled ones.
MIN_DOCS, MIN_LIFT = 5, 2.0
HOT_SHARE = 0.001
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def word_hashes(text: str | None) -> set[int]:
    """Hashes of a text's distinct lower-case words, of their beginnings, and of beginnings that several words share."""
    words = set((text or "").lower().encode("utf-8", "surrogatepass").translate(_FOLD).split())
    crc = zlib.crc32
    out = {crc(w) for w in words}
    for n in BEGINNINGS:
        heads = [w[:n] for w in words if len(w) > n]
        distinct = set(heads)
        out.update([crc(h, n) for h in distinct])
        if len(distinct) < len(heads):
            seen: set[bytes] = set()
            out.update([crc(h, n + 100) for h in heads if h in seen or seen.add(h)])
    return out


@dataclass
class Sparse:
    """Of n documents, the numbers of the features that each has: columns[i] for document rows[i]."""

    n: int
    rows: np.ndarray
    columns: np.ndarray

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.columns], self.n) + w[-1]

    def back(self, by_doc: np.ndarray, size: int) -> np.ndarray:
        return np.append(np.bincount(self.columns, by_doc[self.rows], size), by_doc.sum())


def sparse(docs: list[np.ndarray]) -> Sparse:
    flat = np.concatenate(docs).astype(np.int64) if docs else np.zeros(0, np.int64)
    return Sparse(len(docs), np.repeat(np.arange(len(docs)), [len(d) for d in docs]), flat)


class Model:
    """words: sorted feature hashes, with their weights; bias: for a text without features."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, bias: float):
        self.words, self.weights, self.bias = words, weights, bias

    def scorer(self) -> Callable[[list], dict]:
        lookup = Lookup(self.words)

        def score(texts: list) -> dict:
            own = lookup.sparse(texts)
            raw = self.bias + np.bincount(own.rows, self.weights[own.columns], own.n)
            return {"score": 1 / (1 + np.exp(-np.clip(raw, -40, 40)))}

        return score

    def scores(self, texts: list) -> np.ndarray:
        return self.scorer()(texts)["score"]


class Lookup:
    """Places of texts' features among sorted words."""

    def __init__(self, words: np.ndarray):
        self.words, self.known = words, frozenset(words.tolist())

    def sparse(self, texts: list) -> Sparse:
        found = [self.known & word_hashes(t) for t in texts]
        flat = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
        return Sparse(len(texts), np.repeat(np.arange(len(texts)), list(map(len, found))), np.searchsorted(self.words, flat))


def risk(w: np.ndarray, positive: Sparse, unlabelled: Sparse, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """prior * R+(positive); R-(unlabelled) - prior * R-(positive); and the slopes of both, for the logistic loss."""
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    size = len(w) - 1
    zp, zu = positive.times(w), unlabelled.times(w)
    np_, nu = positive.n, max(unlabelled.n, 1)
    toxic = prior * np.logaddexp(0, -zp).mean()
    rest = np.logaddexp(0, zu).sum() / nu - prior * np.logaddexp(0, zp).mean()
    to_toxic = prior * positive.back((sigmoid(zp) - 1) / np_, size)
    to_rest = unlabelled.back(sigmoid(zu) / nu, size) - prior * positive.back(sigmoid(zp) / np_, size)
    return toxic, rest, to_toxic, to_rest


def fit_nnpu(positive: Sparse, unlabelled: Sparse, size: int, prior: float, steps: int = 600, rate: float = 0.05, ridge: float = 3e-4) -> np.ndarray:
    """Weights of `size` features and the bias, by Adam; where the negatives' part of the risk falls below zero, its ascent is undone."""
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        _, rest, to_toxic, to_rest = risk(w, positive, unlabelled, prior)
        g = to_toxic + to_rest if rest >= 0 else -to_rest
        g[:-1] += ridge * w[:-1]
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def feature_counts(docs: DataFrame, text_col: str, words: np.ndarray | None = None, hot: dict[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): in how many documents each feature occurs, or each of the sorted words.

    Counted in each task, then summed. A text whose xxhash64 is in `hot` weighs one by its number of copies.
    Without words only features of MIN_DOCS documents are returned.
    """
    ddl = "h long, n double"
    schema = arrow_fields(ddl)
    hot = hot or {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, float] = {}
        lookup = None if words is None else Lookup(words)
        known = np.zeros(0 if words is None else len(words))
        for batch in batches:
            weights = [1 / hot.get(k, 1) for k in batch.column(1).to_pylist()]
            done = 0
            for part in slices(batch.column(0)):
                own = weights[done : done + len(part)]
                done += len(part)
                if lookup:
                    found = lookup.sparse(part.to_pylist())
                    known += np.bincount(found.columns, np.array(own)[found.rows], len(known))
                    continue
                for text, weight in zip(part.to_pylist(), own, strict=True):
                    for h in word_hashes(text):
                        total[h] = total.get(h, 0.0) + weight
        if words is not None:
            some = np.flatnonzero(known)
            yield pa.RecordBatch.from_arrays([pa.array(words[some].astype(np.int64)), pa.array(known[some])], schema=schema)
        else:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.float64())], schema=schema)

    found = docs.select(F.col(text_col), F.xxhash64(text_col)).mapInArrow(count, ddl).groupBy("h").agg(F.sum("n").alias("n"))
    table = (found.where(F.col("n") >= MIN_DOCS) if words is None else found).orderBy("h").toArrow()
    return table["h"].to_numpy().astype(np.uint32), table["n"].to_numpy()


def _chosen(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The texts of a sample of ids of bounded size; equal texts count once."""
    own = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(ids), "__id")
    return checkpointed(own.select(F.xxhash64("__text").alias("k"), "__text").dropDuplicates(["k"]))


def _gathered(chosen: DataFrame, words: np.ndarray) -> Sparse:
    """The places of the chosen documents' features among the sorted words."""

    def build() -> Callable[[list], dict]:
        lookup = Lookup(words)
        return lambda texts: {"h": [np.sort(lookup.sparse([t]).columns).astype("<i4").tobytes() for t in texts]}

    rows = chosen.select("k", struct_kernel(build, "h binary")(F.col("__text"))["h"].alias("h")).collect()
    return sparse([np.frombuffer(bytes(r.h), "<i4") for r in sorted(rows, key=lambda r: r.k)])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learns from the labels outside of the held-out fold; the prior is their toxic share."""
    nothing = Model(np.zeros(0, np.uint32), np.zeros(0), -40.0)
    usable = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & (fold(F.col(id_col), FOLDS) != HELD_OUT))
    one = usable.groupBy(F.col(id_col).alias("__id")).agg(F.max("toxic").alias("toxic"))
    counts = one.agg(F.count("*").alias("n"), F.sum(F.col("toxic").cast("long")).alias("toxic")).first()
    if not counts.n or not counts.toxic:
        return nothing
    by_hash = [F.xxhash64("__id"), F.col("__id")]
    positive = _chosen(docs, one.where("toxic = 1").select("__id").orderBy(*by_hash).limit(MAX_POSITIVE), id_col, text_col)
    n_positive = positive.count()
    if not n_positive:
        return nothing
    words, seen = feature_counts(positive, "__text")

    others = docs.where(F.col(id_col).isNotNull() & (fold(F.col(id_col), FOLDS) != HELD_OUT))
    copies = others.groupBy(F.xxhash64(text_col).alias("k")).agg(F.count("*").alias("n"))
    total = others.count()
    hot = {r.k: r.n for r in copies.where(F.col("n") > max(1, int(HOT_SHARE * total))).collect()}  # 1 / HOT_SHARE rows at most
    total -= sum(hot.values()) - len(hot)
    common, n = feature_counts(others, text_col, words, hot)
    elsewhere = np.zeros(len(words))
    elsewhere[np.searchsorted(words, common)] = n
    often = seen / n_positive >= MIN_LIFT * (elsewhere / max(total, 1))
    words = words[often]

    sample = others.select(F.col(id_col).alias("__id")).orderBy(*by_hash).limit(MAX_UNLABELLED).distinct()
    prior = min(max(counts.toxic / counts.n, 0.001), 0.9)
    w = fit_nnpu(_gathered(positive, words), _gathered(_chosen(docs, sample, id_col, text_col), words), len(words), prior)
    return Model(words, w[:-1], float(w[-1]))


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    score: Column = struct_kernel(lambda: model.scorer(), "score double")(F.col(text_col))["score"]
    scored = docs.select(F.col(id_col), score.alias("score"))
    return scored.select(
        F.col(id_col),
        F.coalesce(fold(F.col(id_col), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def toxicity_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted for each row of docs."""
    return score_toxicity(docs, fit_toxicity(docs, labels, id_col, text_col), id_col, text_col)
