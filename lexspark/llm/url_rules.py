"""URL filters: pattern rules indexed by their rarest literal token.

Host rules decide first: a rule fits its host and all subdomains if the path starts with the rule's path,
and the longest fitting rule gives the verdict. Other urls go to the pattern rules. A pattern rule names
literal tokens that any url it matches must hold. Over all urls the tokens are counted, each rule is filed
under its rarest one, a url's tokens fetch candidate rules, and only those run their regular expressions.

Rules are given by the caller, not found in the data; MAX_RULES bounds what is sent to the executors at once. More
rules of either sort run in blocks of that size, one pass over the urls each, whose results are put together.

A null url, or one without "://", has empty host and path, and no pattern rule is tried on it: it is
allowed. Very long urls are searched whole. Of rules of equal length the one of the longer host decides. Repeated rows are judged row by row, an empty table gives an empty table, further columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import arrow_fields, checkpointed, slices, struct_kernel

MAX_RULES = 50_000
#: Fixed values of the query: (verdict, host and path).
HOST_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@dataclass(frozen=True)
class PatternRule:
    """pattern: searched in the lower-cased url; tokens: runs of [a-z0-9] that each matching url has."""

    name: str
    pattern: str
    tokens: tuple[str, ...]


#: The default pattern rules.
PATTERN_RULES = (
    PatternRule("casino-host", r"://([^/?#]*[.-])?casino[.-]", ("casino",)),
    PatternRule("bets-host", r"://([^/?#]*[.-])?free-bets\.", ("free", "bets")),
    PatternRule("adult-host", r"://([^/?#]*[.-])?adult-", ("adult",)),
    PatternRule("spam-farm-host", r"://([^/?#]*\.)?spam-farm\.", ("spam", "farm")),
    PatternRule("poker-path", r"://[^/?#]*/([^?#]*/)?poker(/|$)", ("poker",)),
    PatternRule("torrent-file", r"\.torrent([?#]|$)", ("torrent",)),
    PatternRule("click-tracker", r"[?&]click=track(&|#|$)", ("click", "track")),
    PatternRule("login-page", r"://[^/?#]*/(wp-)?login\.php([?#]|$)", ("php",)),
)
_TOKEN = re.compile("[a-z0-9]+").findall
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
FIELDS = "host string, path string, rule string, pattern string, candidates int, verdict string"


def split_url(url: str | None) -> tuple[str, str]:
    head, sign, rest = (url or "").partition("://")
    if not sign:
        return "", ""
    cut = re.search("[/?#]", rest)
    host, tail = (rest, "") if cut is None else (rest[: cut.start()], rest[cut.start() :])
    return host.translate(_ASCII_LOWER), re.split("[?#]", tail, maxsplit=1)[0]


class HostRules:
    """Longest fitting rule of a host and path; a host's suffixes are looked up, not all rules."""

    def __init__(self, rules: tuple[tuple[str, str], ...]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))
        for own in self.by_host.values():
            own.sort(key=lambda x: (-len(x[0]), x[1]))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        while host:
            for start, rule, verdict in self.by_host.get(host, ()):
                if path.startswith(start):
                    if best is None or len(rule) > len(best[0]):
                        best = rule, verdict
                    break
            host = host.partition(".")[2]
        return best


def token_counts(urls: DataFrame, url_col: str, tokens: frozenset[str]) -> dict[str, int]:
    """In how many urls each of a bounded set of tokens occurs, over all urls."""
    names = sorted(tokens)
    ids = {t: i for i, t in enumerate(names)}
    schema = arrow_fields("token int, n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * len(names)
        for batch in batches:
            for part in slices(batch.column(0)):
                for url in part.to_pylist():
                    if url:
                        for i in {ids[t] for t in _TOKEN(url.translate(_ASCII_LOWER)) if t in ids}:
                            total[i] += 1
        some = [i for i, n in enumerate(total) if n]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([total[i] for i in some], pa.int64())], schema=schema)

    rows = urls.select(F.col(url_col)).mapInArrow(count, "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {names[r.token]: r.n for r in rows}  # a row for each token of the rules at most


def rarest_index(rules: tuple[PatternRule, ...], counts: dict[str, int]) -> dict[str, list[PatternRule]]:
    index: dict[str, list[PatternRule]] = {}
    for rule in rules:
        index.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(rule)
    return index


def _kernel(hosts: tuple[tuple[str, str], ...], index: dict[str, list[PatternRule]]) -> Callable[[], Callable[[list], dict]]:
    def build() -> Callable[[list], dict]:
        host_rules = HostRules(hosts)
        compiled: dict[str, Callable] = {}

        def judge(url: str | None) -> tuple:
            host, path = split_url(url)
            found = host_rules.find(host, path)
            if found:
                return host, path, found[0], None, 0, found[1]
            if "://" not in (url or ""):
                return host, path, None, None, 0, "allow"
            low = url.translate(_ASCII_LOWER)
            candidates = [r for t in dict.fromkeys(_TOKEN(low)) for r in index.get(t, ())]
            for rule in sorted(candidates, key=lambda r: r.name):
                if rule.pattern not in compiled:
                    compiled[rule.pattern] = re.compile(rule.pattern).search
                if compiled[rule.pattern](low):
                    return host, path, None, rule.name, len(candidates), "block"
            return host, path, None, None, len(candidates), "allow"

        names = [f.split()[0] for f in FIELDS.split(", ")]
        return lambda urls: dict(zip(names, zip(*map(judge, urls)), strict=True))

    return build


def url_verdicts(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    hosts: tuple[tuple[str, str], ...] = HOST_RULES,
    patterns: tuple[PatternRule, ...] = PATTERN_RULES,
) -> DataFrame:
    """A row of FIELDS for each row of pages; `pattern` names the rule that blocked, the first by name."""
    if not all(r.tokens for r in patterns):
        raise ValueError("a pattern rule needs a literal token")
    urls = pages.select(F.col(id_col), F.col(url_col))
    out = None
    for a in range(0, max(1, len(patterns), len(hosts)), MAX_RULES):
        block = patterns[a : a + MAX_RULES]
        counts = token_counts(urls, url_col, frozenset(t for r in block for t in r.tokens))
        judged = struct_kernel(_kernel(hosts[a : a + MAX_RULES], rarest_index(block, counts)), FIELDS)(F.col(url_col))
        if out is None:
            out = urls.select("*", judged.alias("__v"))
        else:
            out = checkpointed(out).select("*", judged.alias("__w")).withColumn("__v", _merged(F.col("__v"), F.col("__w"))).drop("__w")
    return out.select(F.col(id_col), "__v.*")


def _merged(v: Column, w: Column) -> Column:
    """The results of two blocks: the longest host rule; else the first pattern by name, and all candidates."""
    rank = lambda x: F.struct(F.length(x["rule"]).alias("n"), F.length(F.substring_index(x["rule"], "/", 1)).alias("h"))
    later = v["rule"].isNull() | (w["rule"].isNotNull() & (rank(w) > rank(v)))
    rule = F.when(later, w["rule"]).otherwise(v["rule"])
    name = F.when(rule.isNull(), F.least(v["pattern"], w["pattern"]))
    by_rule = F.when(later, w["verdict"]).otherwise(v["verdict"])
    return F.struct(
        v["host"].alias("host"),
        v["path"].alias("path"),
        rule.alias("rule"),
        name.alias("pattern"),
        F.when(rule.isNull(), v["candidates"] + w["candidates"]).otherwise(0).alias("candidates"),
        F.when(rule.isNotNull(), by_rule).when(name.isNotNull(), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
    )


def oracle(hosts: tuple[tuple[str, str], ...] = HOST_RULES, patterns: tuple[PatternRule, ...] = PATTERN_RULES) -> str:
    """The same verdicts in SQL, by trying every rule on every url."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def fits(rule: str) -> str:
        host, slash, path = rule.partition("/")
        return f"((host = {text(host)} OR ends_with(host, {text('.' + host)})) AND starts_with(path, {text(slash + path)}))"

    longest = sorted(hosts, key=lambda r: (-len(r[1]), r[1]))
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN {text(r)}" for _, r in longest) + " END"
    verdicts = "CASE rule " + " ".join(f"WHEN {text(r)} THEN {text(v)}" for v, r in hosts) + " END"
    tried = "CASE " + " ".join(f"WHEN regexp_matches(low, {text(p.pattern)}) THEN {text(p.name)}" for p in sorted(patterns, key=lambda p: p.name)) + " END"
    return f"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN url IS NOT NULL AND contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest
  FROM pages
), cut AS (
  SELECT page_id, translate(url, '{upper}', '{lower}') AS low, rest IS NOT NULL AS has_rest,
    translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), '{upper}', '{lower}') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts
), ruled AS (SELECT *, {rule} AS rule FROM cut),
tried AS (SELECT *, CASE WHEN rule IS NULL AND has_rest THEN {tried} END AS pattern FROM ruled)
SELECT page_id, host, path, rule, pattern, CASE WHEN rule IS NOT NULL THEN {verdicts} WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM tried"""
