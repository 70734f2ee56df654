"""Benchmark decontamination: prefix-filtered set join.

A window of an item is a set of shingles (single words). All of a window must occur, so by the prefix
principle one shingle is enough to find it: its rarest over all documents. Documents look up each word in
the index of these prefixes; a hit gives window starts, which the positional and length bounds must allow
before the words of the document are compared with the window exactly.

The index is built from benchmark items in blocks of a bounded size, each of which is held against all
documents; the blocks' hits are then put together.

Very long texts are searched whole, in one pass over their words. Null and empty texts have no words. An item without words has no window. Repeated items count once per id, a null
item id is written as an empty string. Repeated documents are judged row by row, empty tables give no
rows or no hits, further columns are passed through untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import arrow_fields, checkpointed, fresh_name, slices, struct_kernel

WINDOW = 10
#: Most bytes of benchmark text in one block. Its index takes about forty times as much memory in each worker, ten times in the task.
BLOCK_BYTES = 4 << 20
HITS = "n_words long, hit_words array<int>, items array<string>"
#: Lower-cases A-Z and turns what is no digit, letter or byte of a longer character into a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def word_counts(docs: DataFrame, text_col: str, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How often each word of a bounded vocabulary occurs in all documents."""
    ids = {w: i for i, w in enumerate(sorted(vocabulary))}
    schema = arrow_fields("word int, n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * len(ids)
        look = ids.get
        for batch in batches:
            for part in slices(batch.column(0)):
                for text in part.to_pylist():
                    for i in map(look, words_of(text)):
                        if i is not None:
                            total[i] += 1
        some = [i for i, n in enumerate(total) if n]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([total[i] for i in some], pa.int64())], schema=schema)

    found = docs.select(F.col(text_col)).mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    names = sorted(vocabulary)
    return {names[r.word]: r.n for r in found.collect()}  # a row for each word of the vocabulary at most


class PrefixIndex:
    """Windows by their rarest word: word -> places of it in windows, window -> its items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], counts: dict[bytes, int], size: int = WINDOW):
        self.windows: dict[tuple[bytes, ...], list[str]] = {}
        for item, words in items:
            for window in windows_of(words, size):
                owners = self.windows.setdefault(window, [])
                if item not in owners:
                    owners.append(item)
        places: dict[bytes, set[tuple[int, int]]] = {}
        for window in self.windows:
            rare = min(window, key=lambda w: (counts.get(w, 0), w))
            places.setdefault(rare, set()).add((window.index(rare), len(window)))
        self.places = {w: sorted(p) for w, p in places.items()}

    def hits(self, words: list[bytes]) -> tuple[list[int], list[str]]:
        """The hit words' numbers, and the items of which a window occurs."""
        places, windows, n = self.places, self.windows, len(words)
        inside: set[int] = set()
        items: set[str] = set()
        for i in [i for i, w in enumerate(words) if w in places]:
            for offset, length in places[words[i]]:
                start = i - offset
                if start < 0 or start + length > n:
                    continue
                owners = windows.get(tuple(words[start : start + length]))
                if owners:
                    inside.update(range(start, start + length))
                    items.update(owners)
        return sorted(inside), sorted(items)


def _kernel(index: PrefixIndex) -> Callable[[], Callable[[list], dict]]:
    def judge(texts: list) -> dict:
        words = [words_of(t) for t in texts]
        found = [index.hits(w) for w in words]
        return {"n_words": list(map(len, words)), "hit_words": [f[0] for f in found], "items": [f[1] for f in found]}

    return lambda: judge


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, list[bytes]]]]:
    size = benchmark.agg(F.sum(F.octet_length(F.col(text_col)) + 64).alias("b")).first().b or 0
    n = -(-size // BLOCK_BYTES)
    for k in range(n):
        own = benchmark.where(F.pmod(F.xxhash64(F.col(item_col), F.col(text_col)), F.lit(n)) == k) if n > 1 else benchmark
        rows = own.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).alias("t")).toLocalIterator()
        if items := [(r.i, w) for r in rows if (w := words_of(r.t))]:
            yield items


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, name: str, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs with the struct of HITS as column name."""
    empty = struct_kernel(_kernel(PrefixIndex([], {})), HITS)
    out: DataFrame | None = None
    for items in _blocks(benchmark, item_col, item_text_col):
        counts = word_counts(docs, text_col, frozenset(w for _, words in items for w in words))
        found = struct_kernel(_kernel(PrefixIndex(items, counts)), HITS)(F.col(text_col))
        if out is None:
            out = docs.select("*", found.alias(name))
            continue
        more = fresh_name(out, "__more")
        a, b = F.col(name), F.col(more)
        joined = F.struct(
            a["n_words"].alias("n_words"),
            F.array_sort(F.array_union(a["hit_words"], b["hit_words"])).alias("hit_words"),
            F.array_sort(F.array_union(a["items"], b["items"])).alias("items"),
        )
        out = checkpointed(out).select("*", found.alias(more)).withColumn(name, joined).drop(more)
    return docs.select("*", empty(F.col(text_col)).alias(name)) if out is None else out


def contaminated(hits: Column) -> Column:
    return F.size(hits["hit_words"]) > 0


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: id, n_words, n_hit, n_items, item ids, contaminated."""
    hits = benchmark_hits(docs.select(F.col(id_col), F.col(text_col)), benchmark, "__hits", text_col)
    h = F.col("__hits")
    return hits.select(
        F.col(id_col),
        h["n_words"].alias("n_words"),
        F.size(h["hit_words"]).cast("long").alias("n_hit"),
        F.size(h["items"]).cast("long").alias("n_items"),
        h["items"].alias("items"),
        contaminated(h).alias("contaminated"),
    )
