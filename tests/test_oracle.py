"""Every query with SQL gives DuckDB's rows on the smallest data; every other core query runs."""

import math

import duckdb
import pytest

from dotledger.plans import consolidation_queries, document_queries, evidence_queries, property_queries, rule_queries

PACKS = {n: pack for pack in (evidence_queries, document_queries, consolidation_queries, rule_queries, property_queries) for n in pack.ORACLE}


def _plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (bool, int)):
        return float(value)
    if isinstance(value, float):
        return round(value, 6)
    return str(value)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in ("papers", "letter_table", "decisions", "blocks", "cos_tokenize", "documents", "sample_registry", "embeddings", "lineitem", "orders", "part", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(PACKS))
def test_same_rows(spark, data, duck, name):
    df = PACKS[name].QUERIES[name](spark, data)
    mine = [{k: v for k, v in zip(df.columns, r)} for r in df.collect()]
    cursor = duck.execute(PACKS[name].ORACLE[name])
    columns = [c[0] for c in cursor.description]
    theirs = [dict(zip(columns, r)) for r in cursor.fetchall()]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    table = lambda rs: sorted((tuple(_plain(r[c]) for c in order) for r in rs), key=repr)
    assert table(mine) == table(theirs)
