"""Vector-space retrieval over a champion-list index, all queries in one plan.

Query side: analysed like documents, counted with a hash aggregation over the
query tokens (the small side), and written once as a table.  One join of the
query terms with the postings then gives everything else: postings carry idf,
weight and norm, so the rows that match (at most ``top_n`` per query term) hold
the query weights as well as the products.  They are written once too, and
query norms and scores are worked out from them; the postings are scanned
once.  Which side of the join is broadcast follows from the bytes of the
written query terms.  With a stored index only the buckets the query terms
fall in are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import cosine, round_score
from .analysis import DEFAULT, AnalyzerConfig, analyze
from .index import Index, term_bucket
from .util import stored

TOP_K = 10  # results kept per query


def query_terms(queries: DataFrame, key: str = "query_id", text: str = "query_text", cfg: AnalyzerConfig = DEFAULT) -> DataFrame:
    """``(query_id, term, cnt, pos, qlen)``; ``pos`` is the first position of the term,
    ``qlen`` the number of analysed tokens (unknown terms included)."""
    analysed = analyze(queries, key, text, cfg, keep_empty=True).withColumnRenamed("n_terms", "qlen")
    return (
        analysed.where(F.col("qlen") > 0)
        .select(key, "qlen", F.posexplode("tokens").alias("p", "term"))
        .groupBy(key, "qlen", "term")
        .agg(F.count(F.lit(1)).cast("int").alias("cnt"), F.min("p").cast("int").alias("pos"))
        .select(key, "term", "cnt", "pos", "qlen")
    )


def reject_repeated_ids(queries: DataFrame, key: str = "query_id") -> None:
    """An id names one query: raises when two rows share one (or have none)."""
    twice = queries.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(key).isNull()).select(key).take(3)
    if twice:
        raise ValueError(f"query ids have to be unique and not null: {[r[0] for r in twice]}")


def matches(qterms: DataFrame, index: Index, key: str = "query_id") -> DataFrame:
    """``(query_id, term, cnt, pos, qlen, rank, doc, idf, dw, norm)``: postings of the query terms.

    A join on ``term``, and on the storage bucket of the index when it is
    stored: bucket values of the query terms prune the files at run time.
    """
    cols = ["term", "rank", index.key, "idf", F.col("weight").alias("dw"), "norm"]
    if not index.buckets:
        return qterms.join(index.postings.select(*cols), "term")
    q = qterms.where("cnt > 0").withColumn("tb", term_bucket("term", index.buckets))
    return q.join(index.postings.select(*cols, "tb"), ["term", "tb"]).drop("tb")


def query_vectors(qterms: DataFrame, matched: DataFrame, key: str = "query_id") -> DataFrame:
    """``(query_id, term, cnt, pos, qlen, idf, weight)``; unknown terms weigh 0.0.

    The first posting of every known term gives its idf.
    """
    known = matched.where("rank = 1").select(key, "term", "idf")
    return (
        qterms.join(known, [key, "term"], "left")
        .withColumn("weight", (F.col("cnt") / F.col("qlen")) * F.coalesce(F.col("idf"), F.lit(0.0)))
        .select(key, "term", "cnt", "pos", "qlen", "idf", "weight")
    )


def query_norms(qvec: DataFrame, key: str = "query_id") -> DataFrame:
    """``(query_id, norm)`` of the query weights ``(query_id, weight)``."""
    return qvec.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))


def _query_weight():
    return ((F.col("cnt") / F.col("qlen")) * F.col("idf")).alias("weight")


def dot_products(matched: DataFrame, key: str = "query_id", doc: str = "doc_id", dealt: Sequence[str] = ()) -> DataFrame:
    """``(query_id, doc, dot, doc_norm, tie)`` for every document sharing a term.

    ``dealt``: columns that follow from the document and by which the rows are
    already dealt to tasks, so that the sums need no shuffle.

    ``tie`` is the smallest ``(query position, posting rank)`` through which
    the document is reached: the order in which a term-at-a-time scorer first
    meets it, used to order equal scores.
    """
    return matched.groupBy(key, *dealt, doc).agg(
        F.sum(_query_weight() * F.col("dw")).alias("dot"),
        F.max("norm").alias("doc_norm"),
        # (query position, posting rank) as one bigint: same order, and a
        # numeric min keeps the aggregation hash-based.
        F.min(F.col("pos").cast("bigint") * F.lit(1 << 32) + F.col("rank")).alias("tie"),
    )


def cosine_scores(matched: DataFrame, key: str = "query_id", doc: str = "doc_id") -> DataFrame:
    """``(query_id, doc, score, tie)``."""
    # Unknown terms weigh nothing, so the matches hold every weight of the norm.
    qn = query_norms(matched.where("rank = 1").select(key, _query_weight()), key).withColumnRenamed("norm", "query_norm")
    return dot_products(matched, key, doc).join(qn, key).select(key, doc, cosine("dot", "doc_norm", "query_norm").alias("score"), "tie")


def rank_top_k(scores: DataFrame, k: int = TOP_K, key: str = "query_id", doc: str = "doc_id") -> DataFrame:
    """``(query_id, rank, doc, score)`` best ``k`` per query.

    Scores are compared at nine decimals so that summation order cannot
    reorder equal scores; equal scores keep the order the scorer met them.
    """
    s = scores.withColumn("score", round_score("score"))
    w = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("tie").asc())
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(key, "rank", doc, "score")


def lookup(index: Index, queries: DataFrame, key: str = "query_id", text: str = "query_text",
           cfg: AnalyzerConfig = DEFAULT, lemma_map: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(query terms, matches)`` of a query set, both written and read back."""
    reject_repeated_ids(queries, key)
    qt = query_terms(queries, key, text, cfg)
    if lemma_map is not None:
        from .lexicon import apply_lemmas

        qt = apply_lemmas(qt, lemma_map, [key, "qlen"]).select(key, "term", "cnt", "pos", "qlen")
    qt = stored(qt, "query-terms")
    return qt, stored(matches(qt, index, key), "matches")


def search(index: Index, queries: DataFrame, k: int = TOP_K, key: str = "query_id", text: str = "query_text",
           cfg: AnalyzerConfig = DEFAULT, lemma_map: DataFrame | None = None) -> DataFrame:
    """End to end: queries ``(key, text)`` -> ``(key, rank, doc, score)``.

    Query ids have to be unique.  Pass the ``lemma_map`` the index was built
    with to lemmatise queries alike.
    """
    _, matched = lookup(index, queries, key, text, cfg, lemma_map)
    return rank_top_k(cosine_scores(matched, key, index.key), k, key, index.key)
