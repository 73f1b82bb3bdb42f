"""Sinks: index artefacts, processed documents, result and index CSV interchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.index import Index, term_bucket
from .files import write_text_files

BUCKETS = 16  # default number of buckets of a stored index

# One way of quoting for all CSV and TSV files: a quote inside a field is doubled.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_index(index: Index, path: str, buckets: int = BUCKETS) -> None:
    """K3/K6: Parquet artefacts under ``path``, replacing those that are there.

    Postings are partitioned by ``tb = term_bucket(term, buckets)``, sorted by
    term: a lookup joins on ``(term, tb)``, so only the buckets the query terms
    fall in are read, and Parquet statistics on the sorted terms skip row
    groups.  Ranges of (bucket, term) are dealt to the tasks, so a bucket has as
    many files as it fills and no task sorts a whole one.  The postings are built and written once; N is counted on
    the written file.  Every write goes to a version folder of its own with
    its ``meta``; ``current`` names the version to read and is replaced last,
    so a write that breaks off leaves the old index in place.
    """
    if buckets < 1:
        raise ValueError("an index has one bucket at least")
    spark = index.postings.sparkSession
    version = f"v-{uuid.uuid4().hex[:12]}"
    out = f"{path}/{version}"
    (
        index.postings.withColumn("tb", term_bucket("term", buckets))
        .repartitionByRange("tb", "term")
        .sortWithinPartitions("tb", "term", "rank")
        .write.partitionBy("tb")
        .parquet(f"{out}/postings")
    )
    n_docs = spark.read.parquet(f"{out}/postings").agg(F.count_distinct(index.key).alias("n_docs"))
    n_docs.select("n_docs", F.lit(buckets).alias("buckets")).write.parquet(f"{out}/meta")
    spark.createDataFrame([(version,)], "version STRING").coalesce(1).write.mode("overwrite").parquet(f"{path}/current")


def write_processed(processed: DataFrame, path: str, key: str = "doc_id") -> None:
    """K1/X15 as a table: ``(key, processed, n_terms)``, replacing what is there (K6)."""
    processed.select(F.col(key), F.array_join("tokens", " ").alias("processed"), "n_terms").write.mode("overwrite").parquet(path)


def write_processed_files(processed: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """K1/K6 as files: one text file per document, named by its key, tokens joined by blanks.

    They replace what is there once all are written.  Returns ``(name, bytes)`` of the files (lazy).
    """
    return write_text_files(processed.withColumn("processed", F.array_join("tokens", " ")), path, key, "processed")


def write_results_csv(results: DataFrame, path: str, key: str = "query_id", doc: str = "doc_name") -> None:
    """K4: CSV ``Query_number,doc_number`` in (query, rank) order; score and rank are not written."""
    (
        results.orderBy(key, "rank")
        .select(F.col(key).cast("string").alias("Query_number"), F.col(doc).cast("string").alias("doc_number"))
        .write.mode("overwrite")
        .options(**CSV_OPTIONS)
        .csv(path)
    )


def write_index_csv(encoded: DataFrame, path: str) -> None:
    """K3: CSV ``Word,Documents`` sorted by word (code-point order)."""
    (
        encoded.orderBy("word")
        .select(F.col("word").alias("Word"), F.col("documents").alias("Documents"))
        .write.mode("overwrite")
        .options(**CSV_OPTIONS)
        .csv(path)
    )


def write_partials_csv(encoded: DataFrame, path: str, batch: str) -> None:
    """K2: one folder ``<batch>=<value>`` of CSV ``Word,Documents`` per partial index.

    Every file is sorted by word.  Rows are not dealt anew: a task writes a file for each batch it has words of, which
    are few as ``encode_partials`` deals them.
    """
    (
        encoded.select(F.col(batch), F.col("word").alias("Word"), F.col("documents").alias("Documents"))
        .sortWithinPartitions(batch, "Word")
        .write.mode("overwrite")
        .options(**CSV_OPTIONS)
        .partitionBy(batch)
        .csv(path)
    )


def write_queries_tsv(queries: DataFrame, path: str, key: str = "query_id", text: str = "query_text") -> None:
    """Query set as TSV with header ``Query number``, ``Query``."""
    (
        queries.select(F.col(key).cast("string").alias("Query number"), F.col(text).alias("Query"))
        .write.mode("overwrite")
        .options(**CSV_OPTIONS)
        .option("sep", "\t")
        .csv(path)
    )
