"""Incremental index build with Structured Streaming.

A directory that keeps receiving text files is indexed micro-batch by
micro-batch: each batch (at most ``files_per_trigger`` files) is analysed and
written as a partial, unpruned index ``(term, doc_id, tf)`` under
``partials/batch=<id>``.  Writing by batch id makes replays idempotent, and
the stream checkpoint (under the session's ``spark.checkpoint.dir`` unless
given) records which files were taken, so a restarted query continues where it
stopped.  ``merged_index`` then merges all partials (sum tf per term and
document, re-prune to the champion lists) into a queryable ``Index``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scoring import rounded_ratio
from ..operators import index as I
from ..operators.analysis import DEFAULT, AnalyzerConfig, analyze
from ..session import scratch_path

# Settings of Spark that a stream of many small batches needs, where the session has none of its own.  Its source lists
# the files of a batch by a job of a task a file; it rewrites the log of all files taken so far every ten batches, which
# grows with the square of their number; and with 4 MB for opening a file a task gets the longest texts together.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LOG_COMPACTION = "spark.sql.streaming.fileSource.log.compactInterval"
OPEN_COST = "spark.sql.files.openCostInBytes"
COMPACT_BATCHES = 1000
OPEN_BYTES = 16 << 10

BINARY_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def text_file_stream(spark: SparkSession, source_dir: str, files_per_trigger: int = 2000, glob: str = "*.txt") -> DataFrame:
    """Streaming ``(doc_id, text, ok)`` over a directory of text files; ``ok`` flags valid UTF-8."""
    raw = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(source_dir)
    )
    return raw.select(
        F.element_at(F.split("path", "/"), -1).alias("doc_id"),
        F.col("content").cast("string").alias("text"),
        F.is_valid_utf8(F.col("content").cast("string")).alias("ok"),
    )


def _counted(stream: DataFrame, cfg: AnalyzerConfig, key: str) -> DataFrame:
    """``(key, n_terms, ok, _t, _c)``, a row a file: analysis and counting are part of the stream's own plan, set up once
    for all batches."""
    valid = stream.select(key, "ok", F.when(F.col("ok"), F.col("text")).alias("text"))
    return I.counted_rows(analyze(valid, key, "text", cfg, keep_empty=True, carry=["ok"]), key, ["ok"])


def _note_progress(spark: SparkSession, out_dir: str, counts: dict[str, int]) -> None:
    """The row ``counts`` as ``progress/batch=<batch>``, in place of what is there: a file made here, as a job for one
    row costs more than the rest of a small batch."""
    made = pa.BufferOutputStream()
    pq.write_table(pa.table({c: pa.array([int(v)], pa.int64()) for c, v in counts.items()}), made)
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    folder = f"{out_dir}/progress/batch={counts['batch']}"
    fs = path(folder).getFileSystem(sc._jsc.hadoopConfiguration())
    fs.delete(path(folder), True)
    # Readers leave out names that begin with an underscore: they see the whole file or none.
    out = fs.create(path(f"{folder}/_part"), True)
    try:
        out.write(bytearray(made.getvalue()))
    finally:
        out.close()
    if not fs.rename(path(f"{folder}/_part"), path(f"{folder}/part-00000.parquet")):
        raise OSError(f"cannot write {folder}/part-00000.parquet")


def _write_partial(out_dir: str, key: str):
    # Expressions are set up here, once: in a small batch that takes as long as its job.
    rejected = F.count_if(~F.col("ok")).alias("rejected")
    documents, tokens = F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("tokens")
    tf = rounded_ratio(F.col("cnt"), F.col("n_terms"))

    def fn(batch: DataFrame, batch_id: int) -> None:
        # Rejected files, documents with tokens and their tokens, observed
        # while the partial is written: a batch's files are read by one job.
        files, seen = Observation(f"files_{batch_id}"), Observation(f"batch_{batch_id}")
        processed = batch.observe(files, rejected).where("ok AND n_terms > 0").observe(seen, documents, tokens)
        partial = I.term_frequencies(I.listed_counts(processed, key), key, tf=tf)
        partial.write.mode("overwrite").parquet(f"{out_dir}/partials/batch={batch_id}")
        # The first batch makes the folder of rejects; later ones write there what they have.
        if files.get.get("rejected", 0) or batch_id == 0:
            batch.where(~F.col("ok")).select(key).write.mode("overwrite").parquet(f"{out_dir}/rejects/batch={batch_id}")
        m = seen.get
        _note_progress(batch.sparkSession, out_dir, {"batch": batch_id, "documents": m.get("documents", 0), "tokens": m.get("tokens", 0)})

    return fn


def stream_partial_indexes(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint: str | None = None,
    files_per_trigger: int = 2000,
    cfg: AnalyzerConfig = DEFAULT,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    stream = _counted(text_file_stream(spark, source_dir, files_per_trigger), cfg, "doc_id")
    writer = (
        stream.writeStream.foreachBatch(_write_partial(out_dir, "doc_id"))
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def progress(spark: SparkSession, out_dir: str) -> DataFrame:
    """``(batch, documents, tokens, documents_so_far)``: what each micro-batch indexed."""
    rows = spark.read.parquet(f"{out_dir}/progress").select("batch", "documents", "tokens")
    running = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("documents_so_far", F.sum("documents").over(running))


def merged_index(spark: SparkSession, out_dir: str, top_n: int | None = I.TOP_N) -> I.Index:
    """Merge every partial written so far into champion lists with statistics and norms."""
    partials = spark.read.parquet(f"{out_dir}/partials").select("term", "doc_id", "tf")
    champs = I.merge_indexes([partials], top_n)
    postings, _ = I.index_postings(champs)
    return I.Index(postings=postings)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    wanted = {LISTING_TASKS: spark.sparkContext.defaultParallelism, LOG_COMPACTION: COMPACT_BATCHES, OPEN_COST: OPEN_BYTES}
    put = [k for k in wanted if spark.conf.get(k, None) is None]
    for k in put:
        spark.conf.set(k, wanted[k])
    try:
        yield
    finally:
        for k in put:
            spark.conf.unset(k)


def build_from_directory(spark: SparkSession, source_dir: str, out_dir: str, files_per_trigger: int = 2000,
                         top_n: int | None = I.TOP_N, cfg: AnalyzerConfig = DEFAULT) -> I.Index:
    """Run the stream to completion over the files present, then merge.

    Meanwhile the session has the settings above, as the source takes them from it.
    """
    with _small_batches(spark):
        q = stream_partial_indexes(spark, source_dir, out_dir, files_per_trigger=files_per_trigger, cfg=cfg)
        q.awaitTermination()
    return merged_index(spark, out_dir, top_n)
