"""Registered queries beside their SQL twins on the smallest tables.

``tools/check_oracles.py`` runs all of them; here those that need no trained
models, so that the suite stays short.
"""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import TINY
from tools.check_oracles import TABLES, rows_of

# Stored models, stream jobs and repeated variants are covered by the tool.
SLOW = ("a05", "a07", "a11", "b10_five_numbers_split", "b15", "d14", "f05_novelties", "g04_onehot", "g06", "h07_roc_auc_split",
        "h08_top_share_recall_split", "i06_stratified_folds_split", "l0", "m0", "n21", "o0")
NAMES = [n for n in entry.oracle_sql() if not n.startswith(SLOW)]


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{TINY}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, TINY)
    got = rows_of(df.columns, [tuple(x) for x in df.collect()])
    rel = duck.execute(entry.oracle_sql()[name])
    assert got == rows_of([d[0] for d in rel.description], rel.fetchall())


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 120
