"""Sources: text directories, index artefacts, CSV/TSV interchange.

Every reader passes an explicit schema; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators import codec
from ..operators.index import Index, index_from_postings
from ..operators.util import ship_package, stored
from ..sinks.files import _store, contents, found_files, qualified, resolved
from ..sinks.writers import CSV_OPTIONS
from .records import read_records

QUERY_TSV = StructType([StructField("Query number", StringType()), StructField("Query", StringType())])
PAIRS_CSV = StructType([StructField("Query_number", StringType()), StructField("doc_number", StringType())])
INDEX_CSV = StructType([StructField("Word", StringType()), StructField("Documents", StringType())])


READ_TASKS = 32  # tasks a core, at most, to read a folder of text files
OPEN_COST, SPLIT = 4 << 20, 128 << 20  # bytes that opening a file counts for, and of one task (as Spark packs files)


def read_index(spark: SparkSession, path: str, key: str = "doc_id") -> Index:
    """S3: the current version of the index artefacts written by ``write_index``."""
    version = spark.read.schema("version STRING").parquet(f"{path}/current").first()["version"]  # one row
    meta = spark.read.parquet(f"{path}/{version}/meta")
    return Index(
        postings=spark.read.parquet(f"{path}/{version}/postings"),
        n_docs_df=meta.select("n_docs"),
        key=key,
        buckets=int(meta.select("buckets").first()["buckets"]),  # one row
    )


def _files_of(spark: SparkSession, path: str, glob: str, recursive: bool) -> DataFrame | None:
    """``(name, path, content)`` of the files in a folder, read by tasks; None where ``path`` is no folder or the tasks
    cannot open its store by themselves.

    The folder is listed once, into a table: the driver holds no name, however many files there are.
    """
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(sc._jsc.hadoopConfiguration())
    if not store.exists(at) or not store.getFileStatus(at).isDirectory():
        return None
    base = resolved(spark, path)
    try:
        _store(base)
    except ValueError:
        return None
    ship_package(spark)
    # A file of no bytes has no content to read (nor has it for Spark's readers).
    found = stored(found_files(spark, base, glob, recursive).where("bytes > 0"), "listing")
    size = found.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()  # one row
    splits = -(-(size["bytes"] + size["files"] * OPEN_COST) // SPLIT)
    names = found.select("name").repartition(max(1, min(splits, READ_TASKS * sc.defaultParallelism)))
    return contents(names, base).select("name", F.concat(F.lit(qualified(spark, path) + "/"), "name").alias("path"), "content")


def read_text_dir(spark: SparkSession, path: str, glob: str = "*.txt", recursive: bool = False) -> tuple[DataFrame, DataFrame]:
    """One document per file -> ``(doc_id, text)`` plus rejected files.

    ``doc_id`` is the file's base name, with ``recursive`` its path below
    ``path`` (so equal names in two folders stay two documents).  Files are
    matched by ``glob`` at listing time (case-sensitive suffix); each is read
    whole.  Files that are not valid UTF-8 are returned in the second frame
    ``(doc_id, path)`` instead of being silently mangled.  Zero-byte files hold
    no tokens and are dropped later by the empty-document filter like any
    other empty text.

    A folder is listed and read by tasks.  Files named by a pattern, and stores
    that only Spark's readers open, are listed by the driver.
    """
    raw = _files_of(spark, path, glob, recursive)
    if raw is not None:
        doc_id = F.col("name") if recursive else F.substring_index("name", "/", -1)
    else:
        reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
        doc_id = F.element_at(F.split("path", "/"), -1)
        if recursive:
            reader = reader.option("recursiveFileLookup", "true")
            # The listing says file:///a or file:/a, whichever the store prefers.
            root = qualified(spark, path).split(":", 1)[-1].rstrip("/").lstrip("/")
            doc_id = F.substring_index(F.col("path"), root + "/", -1)
        # A split holds some thirty small files, as each counts for the cost of opening it: a task takes many splits.
        raw = reader.load(path).select("path", "content").coalesce(READ_TASKS * spark.sparkContext.defaultParallelism)
    named = raw.select(
        doc_id.alias("doc_id"),
        "path",
        F.is_valid_utf8(F.col("content").cast("string")).alias("ok"),
        F.col("content").cast("string").alias("text"),
    )
    return named.where("ok").select("doc_id", "text"), named.where(~F.col("ok")).select("doc_id", "path")


def read_queries_tsv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """``(query_id, query_text)`` from a TSV with header ``Query number``, ``Query``.

    Queries may hold line breaks; large files are read by many tasks all the
    same.  ``multiline=False`` spares the search for record ends where there are none.
    """
    if multiline:
        df = read_records(spark, path, QUERY_TSV, sep="\t")
    else:
        df = spark.read.schema(QUERY_TSV).options(**CSV_OPTIONS).option("sep", "\t").csv(path)
    return df.select(F.col("Query number").alias("query_id"), F.col("Query").alias("query_text"))


def read_pairs_csv(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, doc_number)`` from a results or judgements CSV (all text)."""
    df = spark.read.schema(PAIRS_CSV).options(**CSV_OPTIONS).csv(path)
    return df.select(F.col("Query_number").alias("query_id"), F.col("doc_number").alias("doc_number"))


def read_results_csv(spark: SparkSession, path: str) -> DataFrame:
    """S5 for results: the file order is the rank order; the rank is recovered from it.

    For interchange: results kept as a table carry their rank.  Lines are
    ordered by the number of their part file, the start of their split in it,
    and their place in the split.
    """
    df = spark.read.schema(PAIRS_CSV).options(**CSV_OPTIONS).csv(path)
    ordered = df.select(
        F.col("Query_number").alias("query_id"),
        F.col("doc_number").alias("doc_name"),
        F.regexp_extract(F.col("_metadata.file_name"), "part-([0-9]+)", 1).try_cast("int").alias("_p"),
        F.col("_metadata.file_name").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_i"),
    )
    w = Window.partitionBy("query_id").orderBy("_p", "_f", "_b", "_i")
    return ordered.select("query_id", F.row_number().over(w).alias("rank"), "doc_name")


def read_index_csv(spark: SparkSession, path: str) -> DataFrame:
    """``(word, documents)`` rows of an index CSV (decode with ``codec.decode_postings``).

    Over a folder of partial indexes the folder column (``batch=...``) comes along.
    """
    df = spark.read.schema(INDEX_CSV).options(**CSV_OPTIONS).csv(path)
    rest = [c for c in df.columns if c not in ("Word", "Documents")]
    return df.select(F.col("Word").alias("word"), F.col("Documents").alias("documents"), *rest)


def read_index_csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line, word, documents)`` in the order of the files, lines numbered from 1.

    Lines are numbered within their file; only the line counts of the files are added up in one place.
    """
    df = spark.read.schema(INDEX_CSV).options(**CSV_OPTIONS).csv(path).select(
        F.col("Word").alias("word"),
        F.col("Documents").alias("documents"),
        F.col("_metadata.file_name").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_i"),
    )
    files = df.groupBy("_f").agg(F.count(F.lit(1)).alias("n"))
    by_file = Window.orderBy(F.regexp_extract("_f", "part-([0-9]+)", 1).try_cast("int"), "_f").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("_f", F.coalesce(F.sum("n").over(by_file), F.lit(0)).alias("before"))
    line = F.row_number().over(Window.partitionBy("_f").orderBy("_b", "_i")) + F.col("before")
    return df.join(before, "_f").select(line.cast("bigint").alias("line"), "word", "documents")


def read_partials_csv(spark: SparkSession, path: str, batch: str | None = None) -> DataFrame:
    """Long postings ``(term, doc_id, tf)`` of all partial indexes below ``path``.

    With ``batch``, the column of their folders, it comes along, and postings are dealt by term and batch: while they
    are lists, which takes half the bytes of a row a posting.
    """
    lists = read_index_csv(spark, path)
    if batch is None:
        return codec.decode_postings(lists).select("term", "doc_id", "tf")
    return codec.decode_postings(lists.repartition("word", batch), [batch]).select("term", "doc_id", "tf", batch)


def index_from_csv(spark: SparkSession, path: str) -> Index:
    """S3: a queryable index from a merged index CSV; statistics are worked out from its lists."""
    return index_from_postings(codec.decode_postings(read_index_csv(spark, path)))
