"""Chat formatting: cumulative-snapshot collapse.

Logs often hold each state of a growing conversation. Rolling hashes over a conversation's turns give one
hash for each of its prefixes. A conversation whose own hash is among the proper prefixes of another is a
snapshot: an anti-join leaves it out. Of equal conversations the smallest conv_id stays. What remains is
maximal and is rendered.

Only hashes are compared, never texts with texts; the hashes are SHA-256 over role, text and the hash so
far, so equal hashes mean equal turns. Common openings are one row after aggregation in each task.

Turns are ordered by turn, then role, then text (for the comparison: then the turn's hash), nulls first;
repeated rows are turns like any other. Null
roles and texts differ from empty ones in the comparison and are rendered as empty. Rows without conv_id
form one conversation of their own. A rendered conversation is one string, so it must fit in one. An empty
table gives an empty table, further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import checkpointed

#: The default marks around a turn.
START, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"


def _digest(role: Column, text: Column) -> Column:
    """Of a turn; lengths and null marks keep different turns apart."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(part(role), F.lit("|"), part(text)), 256)


def prefixes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, hashes): the rolling hash of each prefix of each conversation, in order."""
    one = F.struct(F.col(turn).alias("t"), F.col(role).alias("r"), F.col(text).isNotNull().alias("n"), _digest(F.col(role), F.col(text)).alias("d"))
    rolled = F.aggregate(
        F.array_sort(F.collect_list(one)),
        F.array().cast("array<string>"),
        lambda done, x: F.concat(done, F.array(F.sha2(F.concat(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("")), x["d"]), 256))),
    )
    return turns.groupBy(F.col(conv).alias("conv")).agg(rolled.alias("hashes"))


def collapse(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, n_turns, n_copies) of the maximal conversations; n_copies counts equal ones."""
    rolled = checkpointed(prefixes(turns, conv, turn, role, text))
    whole = rolled.select("conv", F.size("hashes").cast("long").alias("n_turns"), F.try_element_at("hashes", F.lit(-1)).alias("hash"))
    distinct = whole.groupBy("hash", "n_turns").agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    proper = rolled.select(F.explode(F.slice("hashes", 1, F.greatest(F.size("hashes") - 1, F.lit(0)))).alias("hash")).distinct()
    return distinct.join(proper, "hash", "left_anti").select("conv", "n_turns", "n_copies")


def chat_format(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, n_turns, n_copies, text) of the maximal conversations, rendered."""
    kept = checkpointed(collapse(turns, conv, turn, role, text)).select(F.struct("conv").alias("key"), "n_turns", "n_copies")
    shown = F.concat(F.lit(START), F.coalesce(F.col(role), F.lit("")), F.lit(MIDDLE), F.coalesce(F.col(text), F.lit("")), F.lit(END))
    one = F.struct(F.col(turn).alias("t"), F.col(role).alias("r"), F.col(text).alias("x"), shown.alias("s"))
    # a struct as key equals itself where the id is null, and the join keeps the grouping's partitions: texts move once
    whole = turns.groupBy(F.struct(F.col(conv).alias("conv")).alias("key")).agg(F.array_sort(F.collect_list(one)).alias("turns"))
    rendered = F.array_join(F.transform("turns", lambda x: x["s"]), "")
    return whole.join(kept, "key").select(F.col("key.conv").alias(conv), "n_turns", "n_copies", rendered.alias("text"))


ORACLE = f"""
WITH part AS (
  SELECT conv_id, turn, role, text,
    coalesce(strlen(role) || ':' || role, '-') || '|' || coalesce(strlen(text) || ':' || text, '-') || chr(30) AS piece
  FROM conversations
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(piece, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS code,
    string_agg('{START}' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS text
  FROM part GROUP BY conv_id
), one AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, code FROM whole GROUP BY code)
SELECT w.conv_id, w.n_turns, o.n_copies, w.text
FROM one o JOIN whole w ON w.conv_id IS NOT DISTINCT FROM o.conv_id
WHERE NOT EXISTS (SELECT 1 FROM one l WHERE starts_with(l.code, o.code) AND l.code <> o.code)"""
