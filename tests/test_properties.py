"""Properties: independence from partitioning and input order, value ranges."""

from pyspark.sql import functions as F

from quire.operators import evaluate as E
from quire.operators import index as I
from quire.operators import retrieve as R
from quire.operators.analysis import analyze
from quire.plans import pipeline as P

from .conftest import SF001


def _top(spark, docs, queries):
    idx = I.build_index(analyze(docs, "doc_id"))
    return sorted(map(tuple, R.search(idx, queries).collect()))


def test_results_independent_of_partitioning_and_order(spark):
    docs = P.corpus(spark, SF001)
    queries = P.benchmark_queries(spark, SF001)
    base = _top(spark, docs, queries)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        shuffled_docs = docs.repartition(5).orderBy(F.rand(11))
        other = _top(spark, shuffled_docs, queries.orderBy(F.rand(3)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert base == other


def test_value_ranges(spark):
    idx = P.index(spark, SF001)
    res = R.search(idx, P.benchmark_queries(spark, SF001))
    lo, hi = res.agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= lo and hi <= 1.0 + 1e-9
    per_q = E.per_query(E.ranked_ids(E.doc_names(res)), P.qrels(spark, SF001), [1, 3, 10])
    r = per_q.agg(F.min("recall"), F.max("recall"), F.min("ap"), F.max("ap")).first()
    assert 0.0 <= r[0] and r[1] <= 1.0 and 0.0 <= r[2] and r[3] <= 1.0
    # at most top_n postings per term, tf of a document sums to one before rounding
    assert idx.postings.groupBy("term").count().agg(F.max("count")).first()[0] <= I.TOP_N
    tf = I.term_frequencies(I.term_counts(P.processed(spark, SF001)))
    sums = tf.groupBy("doc_id").agg(F.sum("tf").alias("s")).agg(F.min("s"), F.max("s")).first()
    assert abs(sums[0] - 1.0) < 1e-3 and abs(sums[1] - 1.0) < 1e-3
