"""A few registered queries against their DuckDB twins at sf0.001 (the full
set runs with tools/check_oracle.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

NAMES = ["page_chunks", "article_text_kept", "corpus_lines", "vocab", "encoded_docs", "batches",
         "early_stop", "nucleus", "top_p_draw", "crawl_rejects", "run_snapshots", "cut_at_eos"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
