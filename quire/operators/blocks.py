"""Top-k search over unpruned postings, skipping blocks by their bounds.

Documents are dealt into small ranges by a hash of their key.  The postings of
one term within one range are a block, and each block knows the largest share
of a cosine any of its postings can give (``weight / norm``).  Products of
query and document weights are never negative (both carry the idf of one
term), so the sum of these shares over the terms of a query bounds the score
of every document of the range (block-max pruning; Ding and Suel, SIGIR 2011).

A search works out the bounds of all (query, range) pairs from the block
table, scores the few ranges of the highest bounds, and takes the k-th score
found there as the floor.  Of the other ranges only those whose bound reaches
the floor are scored.  Nothing else can enter the first k, so the results are
those of the full scorer, order of equal scores included.

Postings are shuffled twice in all: once into ranges of (term, tf, document) that
number them and count df, and once by the range of their document.  They stay
dealt by range (a bucketed table), so norms, blocks, bounds and scores are sums
within a task, and a term in a third of all documents is spread over its ranges.
What a search shuffles is a row a (query, range) pair at most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import cosine, round_score
from ..functions.scoring import idf as idf_expr
from .analysis import DEFAULT, AnalyzerConfig
from .index import corpus_size, ranked_with_df, term_counts, term_frequencies
from .retrieve import TOP_K, dot_products, query_norms, query_terms, rank_top_k, reject_repeated_ids
from .util import stored, stored_by

DOCS_PER_RANGE = 8  # documents of a range, on average: smaller ranges have tighter bounds and more blocks
SLACK = 1e-9  # scores are compared at nine decimals; a bound may fall short of the floor by this much


@dataclass
class BlockIndex:
    """Unpruned postings in blocks, over written tables.

    postings: ``(term, range, rank, key, weight, norm)`` dealt by range;
    blocks: ``(term, range, share, n)``, summed from them in place; terms: ``(term, df, idf)``.
    """

    postings: DataFrame
    blocks: DataFrame
    terms: DataFrame
    ranges: int
    key: str = "doc_id"


def build_blocks(processed: DataFrame, key: str = "doc_id", docs_per_range: int = DOCS_PER_RANGE) -> BlockIndex:
    """Index of all postings of analysed documents ``(key, tokens, n_terms)``; keys have to be unique."""
    # Documents are whole in a task here: their distinct count shuffles a row a document.
    counted = stored(term_frequencies(term_counts(processed, key), key), "unranked", compression="zstd")
    n_docs = corpus_size(counted, key).first()["n_docs"]
    ranges = max(1, -(-n_docs // docs_per_range))
    ranked = ranked_with_df(counted, key)
    idf = idf_expr("df", F.lit(n_docs))
    terms = stored(ranked.where("rank = 1").select("term", "df", idf.alias("idf")), "terms")
    parts = int(processed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int")
    weight = F.col("tf") * idf
    norm = F.sqrt(F.sum(weight * weight).over(Window.partitionBy("range", key)))
    placed = ranked.where(F.col(key).isNotNull()).repartition(parts, dealt).withColumn("range", dealt)
    placed = stored_by(placed.select("term", "range", "rank", key, "tf", "df", norm.alias("norm")), "block-postings", "range", parts)
    postings = placed.select("term", "range", "rank", key, weight.alias("weight"), "norm")
    blocks = postings.groupBy("term", "range").agg(F.max(_share("weight")).alias("share"), F.count(F.lit(1)).alias("n"))
    return BlockIndex(postings, blocks, terms, ranges, key)


def _share(weight: str) -> Column:
    """The largest part of a cosine that a posting can give."""
    return F.when(F.col("norm") != 0, F.abs(weight) / F.col("norm")).otherwise(0.0)


def _query_vectors(index: BlockIndex, qterms: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(key, term, cnt, pos, qlen, idf, part)`` of the known terms, and the norms ``(key, query_norm)``.

    ``part`` is the weight of the term within the normed query.
    """
    known = qterms.join(index.terms.select("term", "idf"), "term")
    weight = (F.col("cnt") / F.col("qlen")) * F.col("idf")
    norms = query_norms(known.select(key, weight.alias("weight")), key).withColumnRenamed("norm", "query_norm")
    part = F.when(F.col("query_norm") != 0, F.abs(weight) / F.col("query_norm")).otherwise(0.0)
    return known.join(norms, key).select(key, "term", "cnt", "pos", "qlen", "idf", part.alias("part")), norms


@dataclass
class BlockSearch:
    """``results`` as ``retrieve.search`` gives them, and ``read`` ``(key, blocks, postings, blocks_read, postings_read)``."""

    results: DataFrame
    read: DataFrame


def search_blocks(index: BlockIndex, queries: DataFrame, k: int = TOP_K, key: str = "query_id", text: str = "query_text",
                  cfg: AnalyzerConfig = DEFAULT, first_ranges: int | None = None) -> BlockSearch:
    """The best ``k`` documents of each query over all postings, exactly as a full scorer ranks them.

    Query ids have to be unique.  ``first_ranges`` ranges of each query are
    scored for its floor (``k`` by default); a query that finds fewer than
    ``k`` documents there has no floor and reads all its blocks.
    """
    reject_repeated_ids(queries, key)
    vectors, norms = _query_vectors(index, stored(query_terms(queries, key, text, cfg), "query-terms"), key)
    vectors, norms = stored(vectors, "query-vectors"), stored(norms, "query-norms")
    # Blocks of the query terms only; a bound is a sum over the blocks of a range, which are in one task.
    blocks = index.blocks.join(vectors.select("term").distinct(), "term", "left_semi")
    bounds = stored(
        blocks.join(vectors.select(key, "term", "part"), "term")
        .groupBy(key, "range")
        .agg(F.sum(F.col("part") * F.col("share")).alias("bound"), F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("postings")),
        "bounds",
    )
    matched = index.postings.withColumnRenamed("weight", "dw").join(vectors, "term")

    def scores(wanted: DataFrame) -> DataFrame:
        dots = dot_products(wanted, key, index.key, ["range"]).join(norms, key)
        return dots.select(key, index.key, cosine("dot", "doc_norm", "query_norm").alias("score"), "tie")

    best = Window.partitionBy(key).orderBy(F.col("bound").desc(), F.col("range"))
    seeds = bounds.withColumn("r", F.row_number().over(best)).where(F.col("r") <= (first_ranges or k)).select(key, "range")
    seeds = stored(seeds, "first-ranges")
    first = stored(best_scores(scores(matched.join(seeds, [key, "range"])), k, key), "first-scores")
    floor = rank_top_k(first, k, key, index.key).where(F.col("rank") == k).select(key, F.col("score").alias("floor"))
    floor = stored(floor, "floors")
    reach = F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - SLACK)
    # The bound again beside the postings, which are dealt by range: a join with the pairs would shuffle them.
    share = _share("dw")
    in_block = Window.partitionBy("range", key, "term").orderBy(share.desc())
    in_range = Window.partitionBy("range", key)
    bounded = matched.withColumn("_n", F.row_number().over(in_block)).withColumn(
        "bound", F.sum(F.when(F.col("_n") == 1, F.col("part") * share).otherwise(0.0)).over(in_range)
    )
    rest = bounded.join(floor, key, "left").where(reach).join(seeds, [key, "range"], "left_anti")
    results = rank_top_k(first.unionByName(scores(rest)), k, key, index.key)
    hits = bounds.join(seeds.withColumn("hit", F.lit(1)), [key, "range"], "left").join(floor, key, "left")
    was_read = F.col("hit").isNotNull() | reach
    read = hits.groupBy(key).agg(
        F.sum("blocks").alias("blocks"),
        F.sum("postings").alias("postings"),
        F.coalesce(F.sum(F.when(was_read, F.col("blocks"))), F.lit(0)).alias("blocks_read"),
        F.coalesce(F.sum(F.when(was_read, F.col("postings"))), F.lit(0)).alias("postings_read"),
    )
    return BlockSearch(results, read)


def best_scores(scores: DataFrame, k: int, key: str) -> DataFrame:
    """The ``k`` best rows of each query with their unrounded scores and ties."""
    w = Window.partitionBy(key).orderBy(round_score("score").desc(), F.col("tie").asc())
    return scores.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r")
