"""Every query with SQL against DuckDB on the smallest tables; the others must give rows."""

import math

import duckdb
import pytest

import __spark_entry__
from lexspark.plans.catalogue import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool) or hasattr(v, "dtype") and v.dtype == bool:
        return int(v)
    if isinstance(v, float) or hasattr(v, "dtype") and v.dtype.kind == "f":
        return round(float(v), 5)
    return int(v) if isinstance(v, int) or hasattr(v, "dtype") else str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(cell(r[k]) for k in order) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    rows = df.collect()
    if name not in ORACLES:
        assert df.columns
        return
    found = duck.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    expected = normal(columns, found.fetchall())
    got = normal(df.columns, rows)
    assert len(got) == len(expected)
    for a, b in zip(got, expected, strict=True):
        assert all(x == y or isinstance(x, float) and isinstance(y, (int, float)) and math.isclose(x, y, abs_tol=2e-5) for x, y in zip(a, b, strict=True)), (a, b)


def test_queries_without_sql(spark, sf, duck):
    """Row by row over the driver's tables, where DuckDB has no counterpart."""
    import difflib
    import re
    from collections import defaultdict

    from lexspark.functions.french import stem

    items = dict(duck.execute("select item_id, text from benchmark").fetchall())
    got = {r.item_id: r.opacity for r in QUERIES["q_ratio_opacity"](spark, sf).collect()}
    assert got == {i: round(1 - difflib.SequenceMatcher(None, items[i], items[i + 1]).ratio(), 6) for i in items if i + 1 in items}

    docs = dict(duck.execute("select doc_id, text from documents").fetchall())
    places = defaultdict(list)
    for r in QUERIES["q_token_offsets"](spark, sf).collect():
        places[r.doc_id].append((r.pos, r.surface, r.start, r.end))
    for i, text in docs.items():
        found = sorted(places[i])
        assert [(s, a, b) for _, s, a, b in found] == [(m.group(), *m.span()) for m in re.finditer(r"\w+(?:[’'-]\w+)*|[^\w\s]", text or "")]
        assert all(text[a:b] == s for _, s, a, b in found)

    words = {w for (t,) in duck.execute("select text from documents where lang = 'fr'").fetchall() for w in re.findall("[a-zà-ÿ]+", (t or "").lower())}
    by_stem = defaultdict(list)
    for w in words:
        by_stem[stem(w)].append(w)
    assert {r.stem: (r.n, r.first_word) for r in QUERIES["q_french_stem"](spark, sf).collect()} == {k: (len(v), min(v)) for k, v in by_stem.items()}


def test_entry(spark):
    assert 0 < __spark_entry__.entry(spark).count() <= 50


def test_contract_names():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(QUERIES) <= set(__spark_entry__.queries())
