"""Effectiveness metrics: AP@k, recall@k, MAP@k, MAR@k.

Everything is keyed by ``query_id`` and the document number as text (ids are
compared as strings: ``007`` is not ``7``).  Ranked lists stay long
``(query_id, rank, doc_no)``; running hit counts are a window, and all cut-offs
are computed in one plan by joining a tiny literal table of ``k`` values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_number

KS = (3, 10)  # cut-offs reported by default


def _ks(spark, ks: Sequence[int]) -> DataFrame:
    ks = sorted(set(int(k) for k in ks))
    if not ks or ks[0] < 1:
        raise ValueError("every k must be >= 1")
    return F.broadcast(spark.createDataFrame([(k,) for k in ks], "k INT"))


def doc_names(results: DataFrame, doc: str = "doc_id", prefix: str = "output_", suffix: str = ".txt") -> DataFrame:
    """Name each result document the way a text-directory corpus would (``output_<id>.txt``)."""
    return results.withColumn("doc_name", F.concat(F.lit(prefix), F.col(doc).cast("string"), F.lit(suffix)))


def ranked_ids(results: DataFrame, key: str = "query_id", name: str = "doc_name", order: str = "rank") -> DataFrame:
    """``(query_id, rank, doc_no)``.

    The first digit run of each name is its number; names without digits are
    dropped and the remaining ranks close up (1, 2, 3, ...).
    """
    numbered = results.select(
        F.col(key).cast("string").alias("query_id"), F.col(order).alias("_o"), first_number(F.col(name).cast("string")).alias("doc_no")
    ).where(F.col("doc_no").isNotNull())
    w = Window.partitionBy("query_id").orderBy("_o")
    return numbered.select("query_id", F.row_number().over(w).alias("rank"), "doc_no")


def normalize_qrels(qrels: DataFrame, key: str = "query_id", doc: str = "doc_no") -> DataFrame:
    """Relevant pairs as text, nulls dropped, duplicates removed: ``(query_id, doc_no)``."""
    return (
        qrels.select(F.col(key).cast("string").alias("query_id"), F.col(doc).cast("string").alias("doc_no"))
        .where(F.col("query_id").isNotNull() & F.col("doc_no").isNotNull())
        .distinct()
    )


def _judged(qrels: DataFrame) -> DataFrame:
    return qrels.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_rel"))


def _flagged(ranked: DataFrame, qrels: DataFrame) -> DataFrame:
    """Each retrieved row with ``hit`` = 1 when its document is relevant to its query."""
    rel = qrels.withColumn("hit", F.lit(1))
    return ranked.join(rel, ["query_id", "doc_no"], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))


def per_query(ranked: DataFrame, qrels: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """G11/G13 together: ``(query_id, k, ap, recall)`` for every judged query and cut-off.

    One pass: retrieved rows flagged against the judgements, a running hit
    count (W3) and a first-occurrence flag per document, both windows on the
    query partitioning; then one aggregation per (query, k).
    AP accumulates precision at every hit (a repeated relevant id counts each
    time) and divides by ``min(|relevant|, k)``; recall counts distinct
    relevant ids in the top k over ``|relevant|``.  Judged queries without
    results score 0.
    """
    spark = ranked.sparkSession
    # Judgements are sets of pairs compared as text, whatever the caller passes.
    qrels = normalize_qrels(qrels)
    ranked = ranked.withColumn("query_id", F.col("query_id").cast("string"))
    by_rank = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_doc = Window.partitionBy("query_id", "doc_no").orderBy("rank")
    hits = (
        _flagged(ranked, qrels)
        .withColumn("hits", F.sum("hit").over(by_rank))
        .where(F.col("hit") == 1)
        .withColumn("first", (F.row_number().over(by_doc) == 1).cast("int"))
        .select("query_id", "rank", (F.col("hits") / F.col("rank")).alias("p"), "first")
    )
    ks_df = _ks(spark, ks)
    per_k = (
        hits.join(ks_df, F.col("rank") <= F.col("k"))
        .groupBy("query_id", "k")
        .agg(F.sum("p").alias("s"), F.sum("first").alias("found"))
    )
    judged = _judged(qrels).crossJoin(ks_df)
    return judged.join(per_k, ["query_id", "k"], "left").select(
        "query_id",
        "k",
        (F.coalesce("s", F.lit(0.0)) / F.least(F.col("n_rel"), F.col("k"))).alias("ap"),
        (F.coalesce("found", F.lit(0)) / F.col("n_rel")).alias("recall"),
    )


def ap_at_k(ranked: DataFrame, qrels: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """``(query_id, k, ap)``."""
    return per_query(ranked, qrels, ks).select("query_id", "k", "ap")


def recall_at_k(ranked: DataFrame, qrels: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """``(query_id, k, recall)``."""
    return per_query(ranked, qrels, ks).select("query_id", "k", "recall")


def map_mar(ranked: DataFrame, qrels: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """``(k, map_k, mar_k)`` averaged over judged queries (0.0 when none)."""
    spark = ranked.sparkSession
    agg = per_query(ranked, qrels, ks).groupBy("k").agg(F.avg("ap").alias("map_k"), F.avg("recall").alias("mar_k"))
    return (
        _ks(spark, ks)
        .join(agg, "k", "left")
        .select("k", F.coalesce("map_k", F.lit(0.0)).alias("map_k"), F.coalesce("mar_k", F.lit(0.0)).alias("mar_k"))
    )


def metric_report(metrics: DataFrame, decimals: int = 4) -> DataFrame:
    """K5: metrics rounded the way they are printed."""
    return metrics.select("k", F.round("map_k", decimals).alias("map_k"), F.round("mar_k", decimals).alias("mar_k"))
