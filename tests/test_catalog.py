"""Every registered query against its DuckDB mirror on the smallest supplied scale."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import SF001

TABLES = "documents benchmark conversations".split()
FAST = [
    "clean_text", "stopword_filter", "processed_docs", "term_counts", "postings_tf", "champions", "idf",
    "doc_norms", "query_vectors", "retrieve_top10", "relevance_pairs", "map_mar", "index_csv_parse", "results_csv",
    "partials_csv_merge", "retrieve_from_index_csv", "retrieve_lemmatized", "dictionary_index", "map_mar_repeated", "text_dir_rejects", "retrieve_unpruned",
]


def _key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: repr(round(v, 9)) if isinstance(v, float) and not math.isnan(v) else repr(v)
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_sql_or_is_declared():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _key(rows, df.columns) == _key(res.fetchall(), ocols)


def test_entry_smoke(spark):
    out = entry.entry(spark)
    assert out.columns == ["query_id", "rank", "doc_id", "score"]
    assert out.count() == 400
