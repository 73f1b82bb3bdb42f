"""DataFrame-level text analysis (X6): corpus rows in, token arrays out.

The chain is one narrow Project (regex split, higher-order array filters); no
shuffle happens until tokens are counted.  Lemmatisation and the dictionary
filter are optional vocabulary-level joins (see ``lexicon``).
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.stopwords import resolve_stop_words


@dataclass(frozen=True)
class AnalyzerConfig:
    """Options of the analysis chain.

    stop_words: ``None``/"english" for the default list, "spark" for Spark ML's
        bundled list, or any sequence of words.
    fused: split forms such as ``cannot`` the way the word tokenizer does.
    """

    stop_words: object = None
    fused: bool = True


DEFAULT = AnalyzerConfig()


def analyze(
    df: DataFrame,
    key: str,
    text_col: str = "text",
    cfg: AnalyzerConfig = DEFAULT,
    keep_empty: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``(key, tokens ARRAY<STRING>, n_terms INT)``; documents without tokens are dropped (F2)
    unless ``keep_empty`` (queries keep them: an empty query simply retrieves nothing)."""
    spark = df.sparkSession
    # Two projections: the lower-cased token array is materialised once, so the
    # fused-form test is a set lookup on it instead of a second scan of the text
    # (lower-casing first is equivalent: fused forms are ASCII).
    words = resolve_stop_words(spark, cfg.stop_words)
    low = df.select(F.col(key), T.lower_tokens(F.split(T._text(F.col(text_col)), T.SEPARATOR)).alias("_low"), *carry)
    toks = T.split_fused_lowered(F.col("_low")) if cfg.fused else F.col("_low")
    out = low.select(F.col(key), T.keep_terms(toks, words).alias("tokens"), *carry)
    if keep_empty:
        return out.withColumn("n_terms", F.size("tokens"))
    # The emptiness test runs inside a generator: a Filter on the token array
    # would be pushed below the projection (and below a repartition) and the
    # whole analysis would be evaluated twice.
    row = F.struct(F.col(key).alias(key), F.col("tokens"), F.size("tokens").alias("n_terms"), *[F.col(c) for c in carry])
    return out.select(F.inline(F.filter(F.array(row), lambda r: r["n_terms"] > 0)))


def dictionary_filter(tokens_long: DataFrame, dictionary: DataFrame, term_col: str = "term") -> DataFrame:
    """Keep the rows of a long token or count table whose term is in ``dictionary``.

    A semi join: the dictionary stays a table of any size, and its measured
    bytes decide whether it is broadcast.
    """
    d = dictionary.select(F.col(dictionary.columns[0]).alias(term_col)).distinct()
    return tokens_long.join(d, on=term_col, how="left_semi")


def dictionary_counts(counts: DataFrame, dictionary: DataFrame, key: str = "doc_id") -> DataFrame:
    """F5 inside the pipeline: counts ``(key, term, cnt, n_terms)`` restricted to ``dictionary``.

    The filter is part of the analysis, so the length of a document is what is
    left of it; documents without a listed word have no rows.
    """
    kept = dictionary_filter(counts, dictionary)
    lengths = kept.groupBy(key).agg(F.sum("cnt").cast("int").alias("n_terms"))
    return kept.select(key, "term", "cnt").join(lengths, key).select(key, "term", "cnt", "n_terms")
