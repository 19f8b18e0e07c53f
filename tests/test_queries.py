"""Every registered query against its SQL on the smallest tables."""

import glob
import os
import re
import unicodedata
from collections import Counter

import duckdb
import pandas as pd
import pytest

from sessionlens.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


def plain(x):
    if x is None or x is pd.NA or x != x:
        return None
    if hasattr(x, "item"):
        x = x.item()
    return str(x + 0.0 if isinstance(x, float) else x)


def rows(df, columns):
    return sorted(str([plain(x) for x in r]) for r in df[columns].itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, sql, name):
    found = catalog.QUERIES[name](spark, FOLDER).toPandas()
    if name in catalog.ORACLES:
        wanted = sql.sql(catalog.ORACLES[name]).df()
        columns = sorted(found.columns)
        assert columns == sorted(wanted.columns)
        assert rows(found, columns) == rows(wanted, columns)


def test_entry_has_all_queries(spark):
    import __spark_entry__

    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() == 5


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_whole_texts_and_all_tokens(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    bare = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    wanted = {r.doc_id: re.sub(r"[ \t\n\x0b\f\r]+", " ", bare(r.text.lower())) for r in docs[docs.lang == "fr"].itertuples() if r.text is not None}
    found = {r["doc_id"]: r["normalized"] for r in catalog.QUERIES["french_words_normalized"](spark, FOLDER).collect()}
    assert {d: t for d, t in found.items() if t is not None} == wanted
    assert any("." in t[:-1] for t in wanted.values())
    turns = pd.read_parquet(f"{FOLDER}/conversations.parquet")
    wanted = Counter((r.conv_id, r.turn, k, re.sub(r"[^\w']", "", w.lower())) for r in turns.itertuples() for k, w in enumerate((r.text or "").split()))
    found = Counter(tuple(r) for r in catalog.QUERIES["token_normal_forms"](spark, FOLDER).collect())
    assert found == wanted and max(k for _, _, k, _ in wanted) > 0
