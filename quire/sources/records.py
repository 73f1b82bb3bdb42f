"""CSV records with line breaks inside quotes, read by many tasks.

A file is read as lines, split by bytes as any text.  Whether a line break ends
a record depends on the quotes before it, so:

1. every task counts quotes along its split, and the records that would start
   in it, once for either state it may begin in (a narrow pass);
2. one row a split is added up in file order: the parity of all quotes before
   gives the state a split begins in, the records started before its first number;
3. lines that are whole records, nearly all, are parsed where they are; only
   those of records of several lines are shuffled, by record, and joined.

Quotes follow the usual rule: a field that holds a quote, a separator or a line
break is quoted, and quotes inside are doubled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.util import ship_package
from ..sinks.writers import CSV_OPTIONS

_LINES = "file STRING, block BIGINT, nth BIGINT, value STRING, quotes BIGINT, before BIGINT, even BIGINT, odd BIGINT"


def _along_splits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per line: its number in the split, quotes in it and before it, and records started up to it
    when the split begins outside (``even``) or inside (``odd``) a quoted field."""
    split, lines, quotes, even, odd = None, 0, 0, 0, 0
    for pdf in batches:
        pdf["quotes"] = pdf["value"].str.count('"').astype("int64")
        for key, part in pdf.groupby(["file", "block"], sort=False):
            if key != split:
                split, lines, quotes, even, odd = key, 0, 0, 0, 0
            total = part["quotes"].cumsum() + quotes
            before = total - part["quotes"]
            at_even = (before % 2 == 0).cumsum() + even
            at_odd = (before % 2 == 1).cumsum() + odd
            yield part.assign(nth=range(lines, lines + len(part)), before=before, even=at_even, odd=at_odd)[
                ["file", "block", "nth", "value", "quotes", "before", "even", "odd"]
            ]
            lines, quotes, even, odd = lines + len(part), int(total.iloc[-1]), int(at_even.iloc[-1]), int(at_odd.iloc[-1])


def _starts(lines: DataFrame) -> DataFrame:
    """``(file, block, inside, first)``: state each split begins in, and records started before it."""
    splits = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), F.max("even").alias("even"), F.max("odd").alias("odd"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    stated = splits.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), zero) % 2 == 1)
    begun = F.when(F.col("inside"), F.col("odd")).otherwise(F.col("even"))
    return stated.withColumn("begun", begun).select("file", "block", "inside", F.coalesce(F.sum("begun").over(earlier), zero).alias("first"))


def record_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, record, block, nth, value, whole)``: every line with the number of its record in the file, from 1;
    ``whole`` where the line is the record."""
    ship_package(spark)
    text = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = text.mapInPandas(_along_splits, _LINES)
    starts = _starts(lines)
    record = F.col("first") + F.when(F.col("inside"), F.col("odd")).otherwise(F.col("even"))
    outside = (F.col("before") + F.col("inside").cast("int")) % 2 == 0
    return lines.join(starts, ["file", "block"]).select("file", record.alias("record"), "block", "nth", "value", (outside & (F.col("quotes") % 2 == 0)).alias("whole"))


def read_records(spark: SparkSession, path: str, schema: StructType, sep: str = ",", header: bool = True) -> DataFrame:
    """Columns of ``schema`` from CSV files whose quoted fields may hold line breaks.

    The same rows as a reader that takes each file in one task.  Blank lines
    between records are left out; a line break inside a field stays as it is.
    """
    lines = record_lines(spark, path)
    whole = lines.where("whole").select("file", "record", F.col("value").alias("text"))
    parts = F.sort_array(F.collect_list(F.struct("block", "nth", "value")))
    joined = (
        lines.where("not whole").groupBy("file", "record").agg(parts.alias("parts"))
        .select("file", "record", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("text"))
    )
    # A carriage return before the line feed belongs to the line end.
    records = whole.unionByName(joined).withColumn("text", F.regexp_replace("text", "\r$", ""))
    records = records.where((F.col("text") != "") & ((F.col("record") > 1) | F.lit(not header)))
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV_OPTIONS.items() if k != "header"}
    return records.select(F.from_csv("text", _ddl(schema), options | {"sep": sep}).alias("r")).select("r.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
