"""End-to-end plans over the supplied tables: corpus -> index -> results -> metrics.

Roles of the supplied tables: ``documents`` is the corpus, ``benchmark``
passages are the queries, and a document is relevant to a passage when it
contains that passage verbatim.  Results name documents ``output_<doc_id>.txt``
as a text-directory corpus would, and evaluation reads the number back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import index as I
from ..operators import lexicon as L
from ..operators import retrieve as R
from ..operators.analysis import DEFAULT, AnalyzerConfig, analyze
from ..operators.containment import contained_pairs
from ..operators.util import spread, stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)`` from ``documents``."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, query_text)`` from ``benchmark``."""
    return spread(
        table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    )


def conversation_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second query set: user turns of ``conversations``; id = ``conv_id:turn``."""
    c = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return spread(c.select(F.concat_ws(":", "conv_id", "turn").alias("query_id"), F.col("text").alias("query_text")))


def qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, doc_no)``: benchmark item -> documents containing its passage (as text ids)."""
    pairs = contained_pairs(corpus(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return E.normalize_qrels(pairs.select(F.col("item_id").alias("query_id"), F.col("doc_id").alias("doc_no")))


def processed(spark: SparkSession, sf_dir: str, cfg: AnalyzerConfig = DEFAULT) -> DataFrame:
    return analyze(corpus(spark, sf_dir), "doc_id", "text", cfg)


def index(spark: SparkSession, sf_dir: str, top_n: int | None = I.TOP_N, cfg: AnalyzerConfig = DEFAULT,
          lemma_map: DataFrame | None = None, dictionary: DataFrame | None = None, kept: bool = False) -> I.Index:
    return I.build_index(processed(spark, sf_dir, cfg), top_n, lemma_map=lemma_map, dictionary=dictionary, kept=kept)


def lemma_map(counts: DataFrame, tags_of=None) -> DataFrame:
    """``(term, lemma)`` of the changed forms in the vocabulary of ``counts`` ``(doc_id, term, cnt)``, as a table.

    ``tags_of`` gives the tag of a form as a column; without it forms are nouns.
    """
    forms = stored(counts.groupBy("term").agg(F.sum("cnt").alias("n")), "vocabulary")
    tags = None if tags_of is None else L.learn_tags(forms.select(F.col("term").alias("form"), tags_of(F.col("term")).alias("tag"), "n"))
    return stored(L.lemma_map_for(forms.select("term"), tags), "lemmas")


def results(spark: SparkSession, sf_dir: str, k: int = R.TOP_K, top_n: int | None = I.TOP_N,
            idx: I.Index | None = None, lemma_map: DataFrame | None = None) -> DataFrame:
    """``(query_id, rank, doc_id, score)`` for every benchmark query."""
    idx = idx if idx is not None else index(spark, sf_dir, top_n, lemma_map=lemma_map, kept=True)
    return R.search(idx, benchmark_queries(spark, sf_dir), k, lemma_map=lemma_map)


def ranked(spark: SparkSession, sf_dir: str, res: DataFrame | None = None) -> DataFrame:
    res = res if res is not None else results(spark, sf_dir)
    return E.ranked_ids(E.doc_names(res))


def metrics(spark: SparkSession, sf_dir: str, ks=E.KS, res: DataFrame | None = None) -> DataFrame:
    """``(k, map_k, mar_k)``."""
    return E.map_mar(ranked(spark, sf_dir, res), qrels(spark, sf_dir), ks)
