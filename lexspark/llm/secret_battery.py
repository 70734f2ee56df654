"""Secret scans: fixed patterns, and a randomness test battery. DataFrame functions only.

The patterns give the base spans. Beside them, every long word whose characters fit an encoding (hex,
base32, base36, base62, base64) is tested for what a random string of that encoding would show: chi-squared
tests of its alphabet's uniformity, over kinds of characters and, for long words, over places in the alphabet,
runs tests about the alphabet's middle and over capitals, small letters, digits and signs (names keep to one for
long), and a test of serial correlation. The least of the p-values, times the
number of tests, is the word's p-value.

Words that a Benjamini-Hochberg step rejects as random are no secrets. The step is taken within each
encoding and length class (powers of two), since short words give the tests less power. It takes the
p-values as they are: their ranks come from range partitions, ranked inside and then offset, so that no task
holds a whole stratum. Words with fewer than MIN_BITS bits of their alphabet are not tested and not reported.

The work on a text grows with its length, by a logarithm faster where it has many words: a word is tested by
string functions and one fold, places and overlaps come from running sums in doubling steps. Very long texts and
words are tested whole. Null and empty texts have no spans. Repeated rows and ties are judged row by row, an
empty table gives an empty table, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexspark.llm.common import checkpointed

#: The base kinds, as (name, pattern, group and least length of it).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
#: Long words of encodings' characters.
WORD = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}"
#: The encodings' alphabets.
ALPHABETS = {
    16: "0123456789abcdef",
    32: "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    36: "0123456789abcdefghijklmnopqrstuvwxyz",
    62: "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    64: "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Letters that are frequent, and that are rare, in words of European languages.
FREQUENT, RARE = "etaoinsr", "ywvkxjqz"
MIN_BITS = 80.0
FDR = 0.05
#: Places in the alphabet are tested from this length on; eight bins, as many as a character's mark allows for.
LONG = 40
PLACE_BINS = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, merge: Callable[[Column, Column], Column], start: Column) -> Column:
    """merge of all values up to each, in doubling steps; start is merge's neutral value."""

    def step(done: Column, k: Column) -> Column:
        far = F.least(F.pow(F.lit(2), k).cast("int"), F.size(done))
        return F.zip_with(done, F.concat(F.array_repeat(start, far), F.slice(done, F.lit(1), F.size(done) - far)), merge)

    rounds = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)).cast("double"))).cast("int")
    steps = F.when(rounds > 0, F.sequence(F.lit(0), rounds - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, values, step)


def spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their places in code points; places follow from the gaps' lengths."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))

    def placed(hits: Column) -> Column:
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, m: g + F.length(m))
        ends = running(lengths, lambda a, b: a + b, F.lit(0))
        return F.zip_with(hits, ends, lambda m, e: F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("m")))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: let(hits, placed))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<s: int, e: int, m: string>>"))


def encoding(word: Column) -> Column:
    """Size of the narrowest alphabet that holds a word with the mix of characters that it asks for; else null."""
    low, up, digit = word.rlike("[a-z]"), word.rlike("[A-Z]"), word.rlike("[0-9]")
    return (
        F.when(word.rlike("^([0-9a-f]+|[0-9A-F]+)$") & digit & (low | up), 16)
        .when(word.rlike("^[A-Z2-7]+=*$") & digit & up, 32)
        .when(word.rlike("^[a-z0-9]+$") & digit & low, 36)
        .when(word.rlike("^[A-Za-z0-9]+$") & digit & low & up, 62)
        .when(word.rlike("^[A-Za-z0-9+/_-]+=*$") & digit & low & up, 64)
    )


def kind_marks(size: int) -> str:
    """A mark for each character of an alphabet: fours of hex digits; else letters that are frequent, middling or rare in words, and others."""
    if size == 16:
        return "".join(str(k // 4) for k in range(16))
    return "".join("3" if not c.isalpha() else "0" if c.lower() in FREQUENT else "2" if c.lower() in RARE else "1" for c in ALPHABETS[size])


def place_marks(size: int) -> str:
    """The bin of each place of an alphabet; bins differ by one place at most."""
    return "".join(str(k * PLACE_BINS // size) for k in range(size))


def class_marks(size: int) -> str:
    """Capitals, small letters, digits and signs."""
    return "".join("0" if c.isupper() else "1" if c.islower() else "2" if c.isdigit() else "3" for c in ALPHABETS[size])


def half_marks(size: int) -> str:
    return "".join("1" if 2 * k >= size else "0" for k in range(size))


def _upper_tail(z: Column) -> Column:
    """Of the normal distribution, to three digits."""
    return 1 / (1 + F.exp(F.least(F.greatest(1.5976 * z + 0.07056 * z * z * z, F.lit(-60.0)), F.lit(60.0))))


def _two_sided(z: Column) -> Column:
    return 2 * _upper_tail(F.abs(z))


def _count(word: Column, part: str) -> Column:
    """How often part occurs in word, without overlaps."""
    return ((F.length(word) - F.length(F.replace(word, F.lit(part), F.lit("")))) / len(part)).cast("double")


def chi_squared(word: Column, marks: str, size: int) -> Column:
    """The p-value of a uniform alphabet, over the bins that marks name (Wilson and Hilferty's approximation)."""
    names = sorted(set(marks))
    df = len(names) - 1

    def test(marked: Column) -> Column:
        n = F.length(marked).cast("double")
        terms = []
        for name in names:
            expected = n * (marks.count(name) / size)
            off = _count(marked, name) - expected
            terms.append(off * off / expected)
        spread = 2 / (9 * df)
        return _upper_tail((F.pow(reduce(lambda a, b: a + b, terms) / df, F.lit(1 / 3)) - (1 - spread)) / spread**0.5)

    return let(F.translate(word, ALPHABETS[size], marks), test)


def runs_test(word: Column, size: int) -> Column:
    """Of runs above and below the alphabet's middle; zero where a word keeps to one half."""

    def test(marked: Column) -> Column:
        n = F.length(marked).cast("double")
        above = _count(marked, "1")
        middle = 2 * above * (n - above) / n + 1
        var = (middle - 1) * (middle - 2) / (n - 1)
        runs = _count(marked, "01") + _count(marked, "10") + 1
        return F.when(var > 0, _two_sided((runs - middle) / F.sqrt(var))).otherwise(0.0)

    return let(F.translate(word, ALPHABETS[size], half_marks(size)), test)


def class_runs_test(word: Column, size: int) -> Column:
    """Of runs of one class of characters: their number's mean and variance are those of a uniform random word."""
    marks = class_marks(size)
    shares = [marks.count(m) / size for m in sorted(set(marks))]
    change = 1 - sum(p * p for p in shares)
    twice = sum(p * (1 - p) ** 2 for p in shares)

    def test(marked: Column) -> Column:
        n = F.length(marked).cast("double")
        runs = F.length(F.regexp_replace(marked, r"(.)\1+", "$1")).cast("double")
        var = (n - 1) * change * (1 - change) + 2 * (n - 2) * (twice - change * change)
        return _two_sided((runs - 1 - (n - 1) * change) / F.sqrt(var))

    return let(F.translate(word, ALPHABETS[size], marks), test)


def serial_test(word: Column, size: int) -> Column:
    """Of the correlation of neighbours' places in the alphabet; one fold carries all sums."""
    codes = F.transform(F.filter(F.split(word, ""), lambda c: c != ""), lambda c: (F.instr(F.lit(ALPHABETS[size]), c) - 1).cast("double"))
    start = F.struct(*[F.lit(0.0).alias(k) for k in ("n", "sum", "squares", "joint", "first", "last")])

    def step(a: Column, v: Column) -> Column:
        return F.struct(
            (a["n"] + 1).alias("n"),
            (a["sum"] + v).alias("sum"),
            (a["squares"] + v * v).alias("squares"),
            (a["joint"] + a["last"] * v).alias("joint"),
            F.when(a["n"] == 0, v).otherwise(a["first"]).alias("first"),
            v.alias("last"),
        )

    def test(a: Column) -> Column:
        n, mean = a["n"], a["sum"] / a["n"]
        around = a["squares"] - n * mean * mean
        joint = a["joint"] - mean * (2 * a["sum"] - a["first"] - a["last"]) + (n - 1) * mean * mean
        return F.when(around > 1e-9, _two_sided((joint / around + 1 / n) * F.sqrt(n))).otherwise(0.0)

    return let(F.aggregate(codes, start, step), test)


def battery(word: Column, size: int) -> Column:
    """The p-value of a word as a random string of the alphabet of that size."""
    always = [chi_squared(word, kind_marks(size), size), runs_test(word, size), class_runs_test(word, size), serial_test(word, size)]
    longer = [*always, chi_squared(word, place_marks(size), size)]
    least = lambda tests: F.least(F.lit(1.0), len(tests) * F.least(*tests))
    return F.when(F.length(word) < LONG, least(always)).otherwise(least(longer))


def candidates(text: Column) -> Column:
    """Tested words of a text: place, encoding, length class and p-value."""
    found = F.transform(spans(text, WORD), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), encoding(x["m"]).alias("size")))
    known = F.filter(found, lambda x: x["size"].isNotNull() & (F.length(x["m"]) * F.log2(x["size"].cast("double")) >= MIN_BITS))

    def tested(x: Column) -> Column:
        body = F.rtrim(F.translate(F.when(x["size"] == 16, F.lower(x["m"])).otherwise(x["m"]), "-_", "+/"), F.lit("="))

        def one(word: Column) -> Column:
            p = reduce(lambda c, size: c.when(x["size"] == size, battery(word, size)), ALPHABETS, F.when(F.lit(False), F.lit(0.0)))
            stratum = F.concat_ws("/", x["size"].cast("string"), F.floor(F.log2(F.length(word).cast("double"))).cast("string"))
            return F.struct(x["s"].alias("s"), x["e"].alias("e"), stratum.alias("stratum"), p.alias("p"))

        return let(body, one)

    return F.transform(known, tested)


def thresholds(tested: DataFrame) -> dict[str, float]:
    """For each stratum of (stratum, p) rows, the largest rejected p-value.

    No p above FDR can be rejected, so the others are only counted. Ranks are taken in two steps: inside a
    range of (stratum, p), then over the counts of the ranges, of which a stratum has no more than there are partitions.
    """
    sizes = tested.groupBy("stratum").agg(F.count("*").alias("m"))
    by_p = tested.where(F.col("p") <= FDR).groupBy("stratum", "p").agg(F.count("*").alias("n"))
    placed = checkpointed(by_p.repartitionByRange("stratum", "p").withColumn("part", F.spark_partition_id()))
    counts = placed.groupBy("stratum", "part").agg(F.sum("n").alias("own"))
    before = (F.sum("own").over(W.partitionBy("stratum").orderBy("part")) - F.col("own")).alias("before")
    inside = F.sum("n").over(W.partitionBy("stratum", "part").orderBy("p")).alias("inside")
    ranked = placed.select("stratum", "part", "p", inside).join(F.broadcast(counts.select("stratum", "part", before)), ["stratum", "part"])
    rank = F.col("before") + F.col("inside")
    rejected = ranked.join(F.broadcast(sizes), "stratum").where(F.col("p") <= rank * FDR / F.col("m"))
    return {r.stratum: r.p for r in rejected.groupBy("stratum").agg(F.max("p").alias("p")).collect()}


def clear(words: Column, base: Column) -> Column:
    """The words that overlap no base span. All are put in order; a word must begin after the furthest end of the
    base spans before it, and end before the nearest start of those after it."""
    none = F.lit(2**31 - 1)
    mark = lambda x, word: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(word).alias("word"))

    def kept(both: Column) -> Column:
        ends = running(F.transform(both, lambda x: F.when(x["word"], F.lit(0)).otherwise(x["e"])), lambda a, b: F.greatest(a, b), F.lit(0))
        starts = running(F.transform(F.reverse(both), lambda x: F.when(x["word"], none).otherwise(x["s"])), lambda a, b: F.least(a, b), none)
        around = F.zip_with(ends, F.reverse(starts), lambda e, s: F.struct(e.alias("end"), s.alias("start")))
        free = F.zip_with(both, around, lambda x, a: F.struct(x["s"].alias("s"), x["e"].alias("e"), (x["word"] & (a["end"] <= x["s"]) & (a["start"] >= x["e"])).alias("free")))
        return F.transform(F.filter(free, lambda x: x["free"]), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))

    both = F.concat(F.transform(words, lambda x: mark(x, True)), F.transform(base, lambda x: mark(x, False)))
    return let(F.array_sort(both), kept)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added) for each row of docs: arrays of (s, k, e), k the number of the kind, in order."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def of_kind(k: int, found: Column) -> Column:
        return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))

    assign = F.filter(spans(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 6)
    base = F.array_sort(F.concat(of_kind(0, assign), of_kind(1, spans(text, ACCESS)), of_kind(2, spans(text, HEX))))
    found = checkpointed(docs.select(F.col(id_col).alias("id"), base.alias("base"), candidates(text).alias("tested")))
    limits = thresholds(found.select(F.explode("tested").alias("t")).select("t.stratum", "t.p"))
    limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv]) if limits else F.create_map().cast("map<string, double>")
    random = F.filter("tested", lambda x: x["p"] > F.coalesce(F.try_element_at(limit, x["stratum"]), F.lit(0.0)))
    return found.select(F.col("id").alias(id_col), "base", of_kind(3, clear(random, F.col("base"))).alias("added"))


def written(found: Column) -> Column:
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", name(x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_assign, n_access, n_hex, n_random, base and all spans as kind:start:end."""
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return scan(docs, id_col, text_col).select(
        F.col(id_col),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.size("added").cast("long").alias("n_random"),
        written(F.col("base")).alias("base"),
        written(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
