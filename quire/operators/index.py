"""Inverted index: term counts, rounded tf, champion lists, idf, norms.

Plan shape (what ``explain`` shows for ``build_index``):

* analysis and term counting are narrow: a document's tokens are one array in
  one row, so they are counted in place (sort + run lengths) and exploded to
  ``(doc_id, term, cnt)`` without any shuffle.  The hash-aggregation
  alternative would ship every distinct (document, term) pair -- about as many
  rows as tokens -- through an exchange that merges nothing;
* the champion list is ``row_number`` over ``term`` with a limit; Catalyst puts
  a partial ``WindowGroupLimit`` before the exchange, so a term present in a
  third of all documents still ships at most ``top_n`` rows per map task;
* document frequency reuses that partitioning (no second exchange);
* N is a global distinct count (one row, broadcast by construction);
* document norms need one exchange on ``doc_id`` over the champion postings,
  which are bounded by ``top_n`` x vocabulary, not by the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import idf as idf_expr
from ..functions.scoring import rounded_ratio
from .util import ship_package, stored

TOP_N = 10  # postings kept per term (champion list length)


def term_counts(processed: DataFrame, key: str = "doc_id", carry: Sequence[str] = ()) -> DataFrame:
    """``(key, term, cnt, n_terms)`` counted inside each row -- no shuffle.

    ``key`` has to be unique: a repeated key is two documents here.
    ``term_counts_grouped`` adds such rows up instead.
    """
    return listed_counts(counted_rows(processed, key, carry), key, carry)


def counted_rows(processed: DataFrame, key: str = "doc_id", carry: Sequence[str] = ()) -> DataFrame:
    """G1 before the lists are taken apart: ``(key, n_terms, *carry, _t ARRAY<term>, _c ARRAY<cnt>)``, a row a document.

    A document's tokens are one array in one row, so they are sorted and
    run-length encoded in place: run starts where a token differs from its
    predecessor, counts are the distances between starts.  Every lambda only
    touches its bound variables or materialised columns (an expression used
    inside a lambda would be re-evaluated per element), and each step is its
    own projection so every array is computed once per row.
    """
    keep = [key, "n_terms", *carry]
    sorted_ = processed.select(*keep, F.sort_array("tokens").alias("_s"))
    starts = sorted_.select(
        *keep,
        "_s",
        F.filter(
            # Nulls sort first, and there is one before the first element.
            F.transform("_s", lambda x, i: F.when(x.isNotNull() & ~x.eqNullSafe(F.get("_s", i - 1)), i).otherwise(F.lit(-1))),
            lambda i: i >= 0,
        ).alias("_st"),
    )
    return starts.select(
        *keep,
        F.transform("_st", lambda i: F.element_at("_s", i + 1)).alias("_t"),
        F.zip_with("_st", F.concat(F.slice("_st", 2, F.size("_st")), F.array(F.size("_s"))), lambda a, b: b - a).alias("_c"),
    )


def listed_counts(counted: DataFrame, key: str = "doc_id", carry: Sequence[str] = ()) -> DataFrame:
    """``(key, term, cnt, n_terms)`` of ``counted_rows``."""
    # An empty array yields one padded (null, null) pair from zip_with: dropped here.  The arrays are zipped inside the
    # generator: Spark infers a filter on a zipped column and would evaluate the whole analysis for it.
    return (
        counted.select(key, "n_terms", *carry, F.inline(F.arrays_zip(F.col("_t").alias("term"), F.col("_c").alias("cnt"))))
        .where(F.col("term").isNotNull())
        .select(key, "term", "cnt", "n_terms", *carry)
    )


def term_counts_grouped(processed: DataFrame, key: str = "doc_id") -> DataFrame:
    """G1 as explode + hash aggregation (partial/final): rows that share a key are one document.

    Same rows as ``term_counts`` where keys are unique.
    """
    lengths = processed.groupBy(key).agg(F.sum("n_terms").cast("int").alias("n_terms"))
    counts = (
        processed.select(F.col(key), F.explode("tokens").alias("term"))
        .groupBy(key, "term")
        .agg(F.count(F.lit(1)).cast("int").alias("cnt"))
    )
    return counts.join(lengths, key).select(key, "term", "cnt", "n_terms")


def term_frequencies(counts: DataFrame, key: str = "doc_id", carry: Sequence[str] = (), tf: Column | None = None) -> DataFrame:
    """``(term, key, tf)`` with ``tf = cnt / n_terms`` kept to six decimals (``tf``: that expression, if the caller has it)."""
    tf = rounded_ratio(F.col("cnt"), F.col("n_terms")) if tf is None else tf
    return counts.select(F.col("term"), F.col(key), tf.alias("tf"), *carry)


def champions(postings: DataFrame, top_n: int | None = TOP_N, key: str = "doc_id") -> DataFrame:
    """The ``top_n`` highest-tf postings per term, ties by ascending document key.

    ``(term, rank, key, tf)``.  ``top_n=None`` keeps every posting (``ranked_postings``).
    """
    if top_n is None:
        return ranked_postings(postings, key)
    w = Window.partitionBy("term").orderBy(F.col("tf").desc(), F.col(key).asc())
    return postings.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n).select("term", "rank", key, "tf")


def ranked_postings(postings: DataFrame, key: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """R2: ``(term, rank, key, tf)`` of every posting, ranks as ``row_number`` would give them.

    No task holds a whole term: postings are dealt into sorted ranges of
    (term, tf, key), so that a frequent term spans as many ranges as it fills.
    Each range is numbered along its order and written; a term that begins in
    an earlier range adds its counts there.  Only the first and the last term of
    a range can go on in another, so that table is broadcast whatever the postings.
    """
    # Ranges are cut by a sample, a pass of its own: over what is written, not over the analysis again.
    return ranked_with_df(stored(postings.select("term", key, "tf"), "unranked"), key, partitions).select("term", "rank", key, "tf")


def ranked_with_df(postings: DataFrame, key: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """``ranked_postings`` of a written table, each row with the number ``df`` of its term's postings.

    Whoever numbers a range counts its terms too, so df needs no join by term.
    """
    spark = postings.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("term").asc(), F.col("tf").desc(), F.col(key).asc()]
    ship_package(spark)
    ranges = postings.select("term", key, "tf").repartitionByRange(n, *order).sortWithinPartitions(*order)
    local = ranges.select(F.spark_partition_id().alias("range"), "term", key, "tf").mapInArrow(
        _numbered, f"range int, term string, `{key}` {postings.schema[key].dataType.simpleString()}, tf double, rank int, n int, head boolean"
    )
    placed = stored(local.select("range", "term", "rank", key, "tf", "n", "head"), "ranked-ranges", compression="zstd")
    # A term that goes on from an earlier range is the first one of the range.
    at_border = placed.where("head").select("term").distinct()
    counts = placed.join(F.broadcast(at_border), "term", "left_semi").where("rank = 1").select("term", "range", F.col("n").cast("bigint").alias("n"))
    earlier = Window.partitionBy("term").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("term")
    sums = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn("all", F.sum("n").over(whole))
    offsets = sums.where(F.col("all") > F.col("n")).select("range", "term", "before", "all")
    rank = (F.col("rank") + F.coalesce("before", F.lit(0))).cast("int")
    return placed.join(F.broadcast(offsets), ["range", "term"], "left").select(
        "term", rank.alias("rank"), key, "tf", F.coalesce("all", F.col("n").cast("bigint")).alias("df")
    )


def _term_starts(terms: pa.Array) -> np.ndarray:
    """True at the first row and at those whose term differs from the one before (nulls are one term)."""
    codes = pc.fill_null(terms.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
    return np.concatenate([[True], codes[1:] != codes[:-1]])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of rows sorted by ``term`` with a ``rank`` from 1 within the term, the term's number of rows ``n``, and a
    ``head`` that marks the very first row; the other columns pass as they are.  The rows of the last term wait for its end."""
    held, head = [], True
    for batch in batches:
        if not batch.num_rows:
            continue
        terms = batch.column("term")
        if held and held[-1].column("term")[-1].as_py() != terms[0].as_py():
            yield from _with_ranks(held, head)
            held, head = [], False
        last = int(np.flatnonzero(_term_starts(terms))[-1])
        if last:
            yield from _with_ranks([*held, batch.slice(0, last)], head)
            held, head = [], False
        held.append(batch.slice(last))
    if held:
        yield from _with_ranks(held, head)


def _with_ranks(parts: list[pa.RecordBatch], head: bool) -> Iterator[pa.RecordBatch]:
    """``_numbered`` for all rows of some terms; ``head``: they begin with the very first row."""
    rows = pa.Table.from_batches(parts)
    starts = _term_starts(rows.column("term").combine_chunks())
    at = np.arange(rows.num_rows, dtype=np.int64)
    rank = at - np.maximum.accumulate(np.where(starts, at, 0)) + 1
    run = np.cumsum(starts) - 1
    rows = rows.append_column("rank", pa.array(rank.astype(np.int32)))
    rows = rows.append_column("n", pa.array(np.bincount(run)[run].astype(np.int32)))
    yield from rows.append_column("head", pa.array((at == 0) & head)).to_batches()


def merge_indexes(partials: Iterable[DataFrame], top_n: int | None = TOP_N, key: str = "doc_id", decimals: int | None = None,
                  batch: str | None = None) -> DataFrame:
    """Union partial ``(term, key, tf)`` indexes, sum tf per (term, doc), re-prune.

    ``decimals`` rounds the sums, so that their order of addition leaves no trace in the ranks.  ``batch`` names a column
    of all partials whose values share no document (rows of a document are all in one batch): sums are then made where
    the postings of a term and batch are, without dealing them anew.
    """
    by = ["term", key] if batch is None else ["term", batch, key]
    parts = [p.select(*by, "tf") for p in partials]
    if not parts:
        raise ValueError("merge_indexes needs at least one partial index")
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    total = F.sum("tf") if decimals is None else F.round(F.sum("tf"), decimals)
    summed = union.groupBy(*by).agg(total.alias("tf"))
    return champions(summed.select("term", key, "tf"), top_n, key)


def partial_indexes(processed: DataFrame, batch: str, key: str = "doc_id") -> DataFrame:
    """Partial, unpruned indexes ``(batch, term, key, tf)``, one per value of ``batch``.

    ``batch`` is a column of ``processed`` carried through counting (a
    document belongs to one batch); nothing is joined or shuffled.
    """
    counts = term_counts(processed, key, carry=(batch,))
    return term_frequencies(counts, key, carry=(batch,)).select(batch, "term", key, "tf")


def corpus_size(champs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row ``n_docs`` = distinct documents left in the (pruned) index."""
    return champs.agg(F.count_distinct(key).alias("n_docs"))


def term_stats(champs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(term, df, idf)``; df and N are taken over the pruned index."""
    n = corpus_size(champs, key)
    df = champs.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # n is a global aggregate: exactly one row, so the cross join is a broadcast of one row.
    return df.crossJoin(F.broadcast(n)).select("term", "df", idf_expr("df", "n_docs").alias("idf"))


@dataclass
class Index:
    """Index artefacts as DataFrames.

    postings: ``(term, rank, doc_id, tf, df, idf, weight, norm)`` -- champion
        postings with the term's statistics and the document's norm carried
        along, so answering queries needs one lookup and no further join.
    n_docs: one-row DataFrame ``(n_docs)``.
    key: name of the document key column.
    """

    postings: DataFrame
    n_docs_df: DataFrame | None = None
    key: str = "doc_id"
    buckets: int | None = None  # postings stored partitioned by ``term_bucket(term, buckets)``

    @property
    def n_docs(self) -> DataFrame:
        if self.n_docs_df is not None:
            return self.n_docs_df
        return self.postings.agg(F.count_distinct(self.key).alias("n_docs"))

    @property
    def terms(self) -> DataFrame:
        cols = ["term", "df", "idf"] + (["tb"] if self.buckets else [])
        return self.postings.where(F.col("rank") == 1).select(*cols)

    @property
    def docs(self) -> DataFrame:
        return self.postings.groupBy(self.key).agg(F.first("norm").alias("norm"))


def term_bucket(term, buckets: int) -> Column:
    """Storage bucket of a term: ``pmod(xxhash64(term), buckets)``."""
    col = F.col(term) if isinstance(term, str) else term
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def _with_df(champs: DataFrame) -> DataFrame:
    return champs.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("term")))


def index_postings(champs: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Attach df, idf, weight and norm to champion postings with window functions.

    df reuses the term partitioning the champion window produced; the norm
    window needs one exchange on the document key.
    """
    n = corpus_size(champs, key)
    by_doc = Window.partitionBy(key)
    p = (
        (champs if "df" in champs.columns else _with_df(champs))
        .crossJoin(F.broadcast(n))
        .withColumn("idf", idf_expr("df", "n_docs"))
        .withColumn("weight", F.col("tf") * F.col("idf"))
        .withColumn("norm", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(by_doc)))
        .select("term", "rank", key, "tf", "df", "idf", "weight", "norm")
    )
    return p, n


def build_index(processed: DataFrame, top_n: int | None = TOP_N, key: str = "doc_id", counting: str = "row",
                lemma_map: DataFrame | None = None, dictionary: DataFrame | None = None, kept: bool = False) -> Index:
    """Lazy index over analysed documents ``(key, tokens, n_terms)``.

    ``counting="row"`` (default) counts inside each row without a shuffle;
    ``"grouped"`` uses explode + partial/final hash aggregation, which ships
    every distinct (document, term) pair through an exchange, and adds up rows
    that share a key.  ``dictionary`` (a table of words) restricts the terms,
    ``lemma_map`` ``(term, lemma)`` lemmatises them; both before tf, as tables.
    ``kept`` writes the champion lists at once, so that N and the norms are
    taken from what is written instead of pruning the postings twice.
    """
    counts = term_counts_grouped(processed, key) if counting == "grouped" else term_counts(processed, key)
    return index_from_counts(counts, top_n, key, lemma_map, dictionary, kept)


def index_from_counts(counts: DataFrame, top_n: int | None = TOP_N, key: str = "doc_id",
                      lemma_map: DataFrame | None = None, dictionary: DataFrame | None = None, kept: bool = False) -> Index:
    """``build_index`` over counts ``(key, term, cnt, n_terms)``: kept as a table (``util.stored``) where a
    dictionary or lemma map was made of them, so that the documents are analysed once."""
    if lemma_map is not None:
        from .lexicon import apply_lemmas

        counts = apply_lemmas(counts, lemma_map, [key, "n_terms"])
    if dictionary is not None:
        from .analysis import dictionary_counts

        counts = dictionary_counts(counts, dictionary, key)
    champs = champions(term_frequencies(counts, key), top_n, key)
    if kept:
        champs = stored(_with_df(champs), "champions")
    postings, _ = index_postings(champs, key)
    return Index(postings=postings, key=key)


def index_from_postings(decoded: DataFrame, key: str = "doc_id") -> Index:
    """An index over champion lists ``(term, rank, key, tf)`` that were read from somewhere."""
    postings, _ = index_postings(decoded.select("term", "rank", key, "tf"), key)
    return Index(postings=postings, key=key)


def nested_view(champs: DataFrame, key: str = "doc_id", top_n: int | None = TOP_N) -> DataFrame:
    """A5: ``(term, postings MAP<key, tf>)`` in rank order (nested form of the index).

    For champion lists: ``top_n`` has to say how long they are, as a map is one row.
    """
    if not top_n:
        raise ValueError("an unpruned index has lists of any length and no nested form")
    champs = champs.where(F.col("rank") <= top_n)
    return champs.groupBy("term").agg(
        F.map_from_entries(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", key, "tf"))),
                lambda s: F.struct(s[key], s["tf"]),
            )
        ).alias("postings")
    )
