"""Best-fit packing: pattern packing by non-negative least squares.

Documents are cut into pieces of at most `capacity` tokens. The histogram of piece lengths has at most
`capacity` entries, however many documents there are. From it, patterns of a few lengths that fill a
sequence are enumerated, non-negative repeat counts are fitted to the histogram by weighted least squares and
rounded at random to a neighbouring whole number (so that counts below one count too, in proportion), as far as the
histogram holds the pattern. Further rounds do the same with what is left. The residual that no round fits is packed best fit, longest first, on counts too. The patterns that are tried are
bounded by PER_LENGTH, MAX_DOCUMENTS and SLACK; whatever they don't reach is part of the residual, so nothing is lost.
The plan says which ranks of a length go to which sequences; pieces then take their places by their rank.

Ranks come in two steps: each length is dealt to about as many cells as the square root of its count, so
neither a cell nor the list of a length's cells grows beyond that root, even for a very frequent length.

Very long texts are cut into pieces like others. Null and empty texts are documents of the end token alone. Rows are packed row by row, so repeated ids
and texts each get their place; a null id stays null. An empty table gives an empty result, and further
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexspark.llm.bpe import WordBpe
from lexspark.llm.common import arrow_fields, checkpointed, slices

CAPACITY = 4096
END_ID = 1
#: Patterns drawn for each length; most documents of a pattern; most tokens that a pattern leaves unused.
PER_LENGTH, MAX_DOCUMENTS, SLACK = 48, 24, 8
#: Rounds of enumerating, fitting and rounding; steps of a fit.
ROUNDS, FIT_STEPS = 8, 120


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int = CAPACITY) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of all pieces of all documents."""
    id_type = docs.schema[id_col].dataType.simpleString()
    ddl = f"id {id_type}, piece int, start long, length long, ids_crc32 long"
    schema = arrow_fields(ddl)
    end = np.array([END_ID], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordBpe(tokenizer_path)
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                row, piece, start, length, crc = [], [], [], [], []
                for k, ids in enumerate(encoder.ids([text or "" for text in part.to_pylist()]), at):
                    ids += end
                    for p, a in enumerate(range(0, len(ids), step)):
                        own = ids[a : a + step]
                        row.append(k)
                        piece.append(p)
                        start.append(a // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                at += len(part)
                arrays = [batch.column(0).take(pa.array(row, pa.int64())), piece, start, length, crc]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) if isinstance(x, list) else x for x, f in zip(arrays, schema, strict=True)], schema=schema)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, ddl)


# ---- the plan: on the histogram alone


def enumerate_patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int, seed: int = 0) -> np.ndarray:
    """Full patterns, as rows of lengths in falling order, filled up with zeros. lengths are sorted.

    For each length: alone; with itself; with PER_LENGTH - 2 second lengths, drawn evenly or by their counts, half of
    them with a drawn third; and each number of repeats, with and without a drawn partner. All are closed by
    the longest lengths that fit.
    """
    rng = np.random.default_rng(seed)
    present = np.zeros(capacity + 1, np.int64)
    present[lengths] = lengths
    below = np.maximum.accumulate(present)  # longest present length that fits
    before = np.concatenate([[0.0], np.cumsum(counts)])

    def drawn(most: np.ndarray, by_count: np.ndarray) -> np.ndarray:
        """For each row a length of at most `most`; 0 where there is none."""
        fit = np.searchsorted(lengths, most, side="right")
        u = rng.random(len(most))
        at = np.where(by_count, np.searchsorted(before, u * before[fit], side="right") - 1, (u * fit).astype(np.int64))
        return np.where(fit > 0, lengths[np.clip(at, 0, len(lengths) - 1)], 0)

    first = np.repeat(lengths, PER_LENGTH)
    draw = np.arange(len(first)) % PER_LENGTH
    second = drawn(np.minimum(capacity - first, first), draw % 2 == 0)
    second[draw == 0] = 0
    second[draw == 1] = np.where(2 * first <= capacity, first, 0)[draw == 1]
    third = drawn(np.minimum(capacity - first - second, second), np.ones(len(first), bool))
    third[(second == 0) | (draw // 2 % 2 == 0)] = 0
    few = np.zeros((len(first), MAX_DOCUMENTS), np.int32)
    few[:, 0], few[:, 1], few[:, 2] = first, second, third

    most = np.minimum(capacity // lengths, MAX_DOCUMENTS - 1)
    own = np.repeat(lengths, 2 * most)
    times = np.concatenate([np.arange(2 * n) // 2 + 1 for n in most])
    repeats = np.where(np.arange(MAX_DOCUMENTS) < times[:, None], own[:, None], 0).astype(np.int32)
    partner = drawn(capacity - own * times, np.ones(len(own), bool))
    repeats[np.arange(len(own)), times] = np.where(np.arange(len(own)) % 2, partner, 0)

    rows = np.unique(-np.sort(-np.concatenate([few, repeats]), axis=1), axis=0)
    room = capacity - rows.sum(axis=1)
    used = (rows > 0).sum(axis=1)
    while len(todo := np.flatnonzero((used < MAX_DOCUMENTS) & (below[room] > 0))):
        closing = below[room[todo]]
        rows[todo, used[todo]] = closing
        room[todo] -= closing
        used[todo] += 1
    return np.unique(-np.sort(-rows[room <= SLACK], axis=1), axis=0)


def fit_counts(patterns: np.ndarray, lengths: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """Non-negative repeat counts whose lengths come nearest to the histogram, by accelerated projected gradients.

    Long lengths weigh more, so that what the fit misses is short and finds a place anywhere.
    """
    weight = np.sqrt(lengths / capacity) + 0.05
    of_pattern, place = np.nonzero(patterns)
    slot = np.searchsorted(lengths, patterns[of_pattern, place])
    scale = max(1.0, float(counts.max()))
    target = weight * counts / scale

    def forward(x: np.ndarray) -> np.ndarray:
        return weight * np.bincount(slot, x[of_pattern], len(lengths))

    def back(r: np.ndarray) -> np.ndarray:
        return np.bincount(of_pattern, (weight * r)[slot], len(patterns))

    v = np.ones(len(patterns))
    for _ in range(15):  # largest eigenvalue, for the step
        v = back(forward(v))
        norm = float(np.linalg.norm(v)) or 1.0
        v /= norm
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(FIT_STEPS):
        nxt = np.maximum(0, y - back(forward(y) - target) / (1.05 * norm))
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x * scale


def fitted_patterns(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, number of sequences) of all rounds; their pieces are taken off `left`, the counts by length."""
    out: list[tuple[tuple[int, ...], int]] = []
    for round_ in range(ROUNDS):
        lengths = np.flatnonzero(left)
        if not len(lengths):
            break
        patterns = enumerate_patterns(lengths, left[lengths].astype(np.float64), capacity, round_)
        if not len(patterns):
            break
        fitted = fit_counts(patterns, lengths, left[lengths].astype(np.float64), capacity)
        rounded = np.floor(fitted + np.random.default_rng(round_).random(len(fitted))).astype(np.int64)
        placed = 0
        for k in np.argsort(-fitted, kind="stable").tolist():
            if not rounded[k]:
                continue
            shape = patterns[k][patterns[k] > 0]
            own, need = np.unique(shape, return_counts=True)
            n = min(int(rounded[k]), int((left[own] // need).min()))
            if n > 0:
                left[own] -= n * need
                placed += n
                out.append((tuple(shape.tolist()), n))
        if not placed:
            break
    return out


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on counts: bins that look alike are one entry."""
    by_room: dict[int, dict[tuple[int, ...], int]] = {}
    rooms = np.zeros(capacity + 1, bool)
    for v in sorted(left, reverse=True):
        todo = left[v]
        while todo:
            fits = np.flatnonzero(rooms[v:])
            if not len(fits):
                break
            room = v + int(fits[0])
            shape, n = next(iter(by_room[room].items()))
            take = min(n, todo)
            todo -= take
            by_room[room].pop(shape)
            if n > take:
                by_room[room][shape] = n - take
            elif not by_room[room]:
                rooms[room] = False
            _put(by_room, rooms, room - v, (*shape, v), take)
        if todo:  # new bins, as full of this length as they get
            each = capacity // v
            if todo >= each:
                _put(by_room, rooms, capacity - each * v, (v,) * each, todo // each)
            if todo % each:
                _put(by_room, rooms, capacity - todo % each * v, (v,) * (todo % each), 1)
    return [(shape, n) for shapes in by_room.values() for shape, n in shapes.items()]


def _put(by_room: dict, rooms: np.ndarray, room: int, shape: tuple[int, ...], n: int) -> None:
    own = by_room.setdefault(room, {})
    own[shape] = own.get(shape, 0) + n
    rooms[room] = True


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, number of sequences) that hold exactly the pieces of the histogram."""
    left = np.zeros(capacity + 1, np.int64)
    for v, n in histogram.items():
        left[v] = n
    fitted = fitted_patterns(left, capacity)
    return fitted + best_fit({int(v): int(left[v]) for v in np.flatnonzero(left)}, capacity)


def placements(packed: list[tuple[tuple[int, ...], int]], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """The plan by ranks: entry k holds the pieces of `length[k]` with ranks from `rank[k]`; sorted by both."""
    rank: dict[int, int] = {}
    rows = []
    sequence = 0
    for shape, n in packed:
        offset = 0
        for v in sorted(shape, reverse=True):
            rows.append((v, rank.get(v, 0), sequence, offset))
            rank[v] = rank.get(v, 0) + n
            offset += v
        sequence += n
    rows.sort()
    length, first, seq, offset = (np.array(x, np.int64) for x in (zip(*rows, strict=True) if rows else ((), (), (), ())))
    return {"length": length, "rank": first, "sequence": seq, "offset": offset}


def _place(batches: Iterator[pa.RecordBatch], entries: dict[str, np.ndarray], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    edge = np.searchsorted(entries["length"], np.arange(int(entries["length"].max(initial=0)) + 2))
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        at = np.empty(len(length), np.int64)
        for v in np.unique(length).tolist():
            own = length == v
            a, b = edge[v], edge[v + 1]
            at[own] = a + np.searchsorted(entries["rank"][a:b], rank[own], side="right") - 1
        columns = batch.columns[:5]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(entries["sequence"][at] + rank - entries["rank"][at]), pa.array(entries["offset"][at])], schema=schema)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = checkpointed(pieces(docs, tokenizer_path, id_col, text_col, capacity))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    entries = placements(plan(histogram, capacity), capacity)

    n_cells = F.ceil(F.sqrt(F.col("n"))).cast("long")
    cells = cut.groupBy("length").agg(F.count("*").alias("n")).select("length", n_cells.alias("cells"))
    dealt = cut.join(F.broadcast(cells), "length")  # capacity rows at most
    spread = F.pmod(F.monotonically_increasing_id(), F.col("cells")).alias("cell")
    dealt = checkpointed(dealt.select("id", "piece", "start", "length", "ids_crc32", spread))
    sizes = dealt.groupBy("length", "cell").agg(F.count("*").alias("n"))
    before = sizes.select("length", "cell", (F.sum("n").over(W.partitionBy("length").orderBy("cell")) - F.col("n")).alias("before"))
    inside = F.row_number().over(W.partitionBy("length", "cell").orderBy("id", "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("inside", inside).join(before, ["length", "cell"])
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside")).alias("rank"))
    id_type = docs.schema[id_col].dataType.simpleString()
    ddl = f"id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    placed = ranked.mapInArrow(partial(_place, entries=entries, schema=arrow_fields(ddl)), ddl)
    return placed.withColumnRenamed("id", id_col)
