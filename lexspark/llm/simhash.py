"""SimHash near-duplicates: byte-position inverted index with count filtering.

A 64-bit fingerprint has eight positional bytes. Two fingerprints that differ in at most two bits share
at least six of them. Lists of single bytes would hold a 256th of all fingerprints each, so the index
joins positional bytes by fives: eleven sets of five positions, of which any six shared positions hold at
least one wholly. Inside a list the shared positional bytes of a pair are tallied, pairs that reach six
are retained and verified by their differing bits.

Equal fingerprints are one entry of the index. Lists of more than PAIRWISE fingerprints are split by a sixth positional
byte, three ways: by the count filter a pair must share one more of the three free bytes, so each pair that reaches
the count is in a split list, and all pairs of one do reach it. Split lists hold 2**16 fingerprints at most, whatever the
input; in long ones the pairs are verified by their possible differences, of which two bytes leave 136, instead of one by
one. Each list yields a spanning forest of its links, not all of them.

Null texts have no words, like empty ones: fingerprint zero, linked like any other, so a group of any size is one entry.
Very long texts are hashed whole. Repeated rows and equal texts (ties) stay rows, of one component. A null id never names a
component unless all its ids are null. An empty table gives an empty table, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexspark.llm.common import checkpointed, fresh_name, struct_kernel
from lexspark.llm.components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
MIN_SHARED = 6
#: Triples of byte positions that cover all pairs of the eight positions.
FREE_BYTES = (
    (0, 1, 2), (0, 3, 4), (0, 5, 6), (0, 1, 7), (1, 3, 5), (1, 4, 6),
    (2, 3, 6), (2, 4, 5), (2, 3, 7), (4, 5, 7), (3, 6, 7),
)
HOT_SHARE = 0.001
#: Lists up to this long are compared pair by pair; longer ones are split by a sixth byte.
PAIRWISE = 256


def fingerprint(text: str | None) -> int:
    """The SimHash of a text's three-word shingles, as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    if n <= SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = [0, *(ends[: n - SHINGLE] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)), np.uint64, n - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[at : at + 65_536].byteswap().view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprint_column(text: Column) -> Column:
    return struct_kernel(lambda: lambda texts: {"fp": [fingerprint(t) for t in texts]}, "fp long")(text)["fp"]


def _forest(n: int, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    top = list(range(n))
    kept = []
    for a, b in pairs:
        x, y = a, b
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        while top[y] != y:
            top[y] = top[top[y]]
            y = top[y]
        if x != y:
            top[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def _difference_links(values: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that link each linked group of sorted values, which agree in the mask `shared`: every member to its group's first."""
    bits = [np.uint64(1 << b) for b in range(64) if not shared >> b & 1]
    label = np.arange(len(values))
    found = []
    for mask in bits + [a | b for a, b in combinations(bits, 2)]:
        other = values ^ mask
        at = np.searchsorted(values, other)
        at[at == len(values)] = 0
        hit = np.flatnonzero((values[at] == other) & (at > np.arange(len(values))))
        if len(hit):
            found.append((hit.astype(np.int32), at[hit].astype(np.int32)))
    while True:
        before = label.copy()
        for a, b in found:
            least = np.minimum(label[a], label[b])
            np.minimum.at(label, a, least)
            np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            break
    member = np.flatnonzero(label != np.arange(len(values)))
    return member, label[member]


def shared_mask(slot: int) -> int:
    """The bits of the positional bytes that a list's fingerprints share: five of them, or six in split lists."""
    free = FREE_BYTES[slot // 4]
    return sum(255 << 8 * (7 - p) for p in range(8) if p not in free or slot % 4 and p == free[slot % 4 - 1])


def list_links(fps: np.ndarray, slot: int) -> np.ndarray:
    """Links inside one list of signed fingerprints: a spanning forest of its pairs within MAX_BITS, as rows (u, v)."""
    if len(fps) == 2:
        x = (int(fps[0]) ^ int(fps[1])) & 0xFFFFFFFFFFFFFFFF
        shared = sum(not x >> 8 * k & 255 for k in range(8))
        return fps.reshape(1, 2) if shared >= MIN_SHARED and x.bit_count() <= MAX_BITS else fps[:0].reshape(0, 2)
    values = np.sort(fps.view(np.uint64))
    if len(values) <= PAIRWISE or slot % 4 == 0:
        x = values[:, None] ^ values[None, :]
        shared = (x.reshape(-1, 1).view(np.uint8) == 0).sum(axis=1).reshape(x.shape)
        a, b = np.nonzero(np.triu(shared >= MIN_SHARED, 1))
        good = np.bitwise_count(x[a, b]) <= MAX_BITS
        pairs = np.array(_forest(len(values), list(zip(a[good].tolist(), b[good].tolist(), strict=True))), np.int64).reshape(-1, 2)
    else:
        pairs = np.stack(_difference_links(values, shared_mask(slot)), axis=1)
    return values.view(np.int64)[pairs]


def _links(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Of structs (slot, fps) the links of each list; fingerprints stay in numpy."""
    pair = pa.struct([("u", pa.int64()), ("v", pa.int64())])
    for array in arrays:
        slots, lists = array.flatten()
        values = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        found = [list_links(values[a:b], k) for a, b, k in zip([0, *ends[:-1].tolist()], ends.tolist(), slots.to_pylist(), strict=True)]
        rows = np.concatenate([np.zeros((0, 2), np.int64), *found])
        offsets = np.cumsum([0, *map(len, found)])
        pairs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in (0, 1)], fields=list(pair))
        yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)


def _entry(slot: int) -> Column:
    mask = shared_mask(slot)
    return F.struct(F.lit(slot).cast("byte").alias("slot"), F.col("fp").bitwiseAND(F.lit(mask - (mask >> 63 << 64))).alias("key"))


def index_links(fps: DataFrame) -> DataFrame:
    """Links (u, v) that join all of the distinct fingerprints (fp) that differ in MAX_BITS or fewer.

    Slots number the sets of shared positions: 4 k is the k-th five, 4 k + 1 to 4 k + 3 split it by each of its free bytes.
    Lists are counted first, so that no list is gathered before it is known to be short.
    """
    fives = range(0, 4 * len(FREE_BYTES), 4)
    entries = fps.select("fp", F.explode(F.array(*map(_entry, fives))).alias("e")).select("e.slot", "e.key", "fp")
    sizes = entries.groupBy("slot", "key").agg(F.count("*").alias("n")).where("n > 1")
    known = checkpointed(sizes.select("slot", "key", (F.col("n") > PAIRWISE).alias("long")))
    split = F.array(*[F.when(F.col("slot") == k, F.array(*[_entry(k + j) for j in (1, 2, 3)])) for k in fives])
    ways = F.when(F.col("long"), F.element_at(split, (F.col("slot") / 4 + 1).cast("int"))).otherwise(F.array(F.struct("slot", "key")))
    dealt = entries.join(known, ["slot", "key"]).select("fp", F.explode(ways).alias("e")).select("e.slot", "e.key", "fp")
    lists = dealt.groupBy("slot", "key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    links = F.arrow_udf(_links, "array<struct<u: long, v: long>>").asNondeterministic()(F.struct("slot", "fps"))
    return lists.select(F.explode(links).alias("l")).select("l.u", "l.v")


def _with_components(rows: DataFrame) -> DataFrame:
    """Rows (id, fp, ...) with the root and the component_id of their fingerprint.

    Fingerprints of more than a HOT_SHARE of all rows, 1 / HOT_SHARE at most, are broadcast, so their rows needn't meet in a task.
    """
    entries = checkpointed(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")))
    roots = connected_components(index_links(entries.select("fp")))
    group = checkpointed(entries.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")))
    smallest = group.groupBy("root").agg(F.min("least").alias("component_id"))
    named = checkpointed(group.join(smallest, "root").select("fp", "root", "component_id", "n"))
    total = entries.agg(F.sum("n")).first()[0] or 0
    hot = named.where(F.col("n") > max(1, int(HOT_SHARE * total))).drop("n")
    loose = rows.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(named.drop("n"), "fp")
    return loose.unionByName(rows.join(F.broadcast(hot), "fp"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) for each row of docs."""
    rows = checkpointed(docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col)).alias("fp")))
    return _with_components(rows).select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs of which each component keeps one: that of the smallest id, or a nameless one where none has an id.

    Where an id repeats with different texts of the component, the text of the smallest hash stays; of rows that repeat
    id and text, one. The decision is made on (id, hash of the text, fingerprint) alone; texts move once. Null texts are
    of the component of empty ones. An empty table gives an empty table, columns of any names pass through.
    """
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).isNull().alias("n"))
    rows = checkpointed(docs.select(key.alias("key"), F.col(id_col).alias("id"), fingerprint_column(F.col(text_col)).alias("fp")))
    first = F.min(F.struct(F.col("id").isNull(), "key"))
    chosen = _with_components(rows).groupBy("root").agg(first.alias("first")).select(F.col("first.key").alias("key"))
    own, once = fresh_name(docs, "__key"), fresh_name(docs, "__once")
    kept = docs.select("*", key.alias(own)).join(chosen.select(F.col("key").alias(own)), own, "left_semi")
    number = F.row_number().over(W.partitionBy(own).orderBy(F.lit(0)))
    return kept.select("*", number.alias(once)).where(F.col(once) == 1).select([F.col(f"`{c}`") for c in docs.columns])
