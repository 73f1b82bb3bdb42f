"""Plan checks: no Python UDF in the hot path, partial top-N before the term exchange,
query side broadcast, column pruning at the scan."""

from quire.operators import retrieve as R
from quire.operators.util import stored as stored_rows
from quire.plans import pipeline as P

from .conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_build_plan(spark):
    idx = P.index(spark, SF001)
    plan = _plan(idx.postings)
    assert "WindowGroupLimit" in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_search_plan_broadcasts_queries(spark):
    idx = P.index(spark, SF001)
    plan = _plan(R.matches(stored_rows(R.query_terms(P.benchmark_queries(spark, SF001)), "t"), idx))
    assert "BroadcastHashJoin" in plan
    assert "PythonUDF" not in plan


def test_scan_reads_only_needed_columns(spark):
    df = P.corpus(spark, SF001)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "lang" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_stored_index_lookup_prunes_term_buckets(spark):
    from quire.session import scratch_path
    from quire.sinks.writers import write_index
    from quire.sources.readers import read_index

    path = scratch_path(spark, "plan-idx")
    write_index(P.index(spark, SF001), path, buckets=8)
    idx = read_index(spark, path)
    q = P.benchmark_queries(spark, SF001)
    stored = R.search(idx, q)
    assert "dynamicpruning" in _plan(R.matches(stored_rows(R.query_terms(q), "t"), idx))
    # One scan of the postings, in the job that writes the matches.
    terms = stored_rows(R.query_terms(q), "t")
    scans = [x for x in _plan(R.matches(terms, idx)).split("\n") if "FileScan parquet" in x and "/postings" in x]
    assert len(scans) == 1
    lazy = R.search(P.index(spark, SF001), q)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, lazy.collect()))
