"""Helpers shared by the operators of this subpackage (and ``stored``, the library's own)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.util import stored  # noqa: F401


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column of ``taken`` has it (any case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def among_smallest(hashed: Column, wanted: int, of: int | Column) -> Column:
    """Whether a 64-bit hash is likely among the ``wanted`` smallest ``of`` so many: thins the rows out
    before they are ordered for a sample, so that what is sent does not grow with their number."""
    share = F.least(F.lit(1.0), F.lit(4.0 * wanted) / F.greatest(of if isinstance(of, Column) else F.lit(of), F.lit(1)).cast("double"))
    return (hashed.cast("double") + F.lit(2.0**63)) / F.lit(2.0**64) <= share
