"""Small plan helpers shared by the operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame

from ..session import SCAN_PARTITIONS, scratch_path


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` to ``partitions`` tasks, by default as many as the session setting
    ``spark.quire.scan.partitions`` says; without the setting ``df`` is returned as it is.

    For tables stored as one large row group.  A large table is read as many
    splits and needs no dealing.
    """
    n = partitions or int(df.sparkSession.conf.get(SCAN_PARTITIONS, "0"))
    return df.repartition(n) if n else df


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage; and joins of what is read back are planned from the bytes
    of its files, so a small side is broadcast by measured size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """``stored`` as a table bucketed by ``column``: what is grouped by it and others later needs no shuffle.

    The table's name is given up once it is read; its files are below the checkpoint folder like those of ``stored``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = "quire_" + path.rsplit("-", 1)[1]
    df.write.format("parquet").bucketBy(buckets, column).option("path", path).option("compression", "zstd").saveAsTable(table)
    kept = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return kept


_SHIPPED: set[str] = set()


def ship_package(spark) -> None:
    """Make this package importable in Python workers (``addPyFile`` of a zip), once per context.

    Operators that run Python in tasks (``mapInPandas``) pickle their helpers by
    module reference, so executors must be able to import the package whatever
    the driver's working directory or the cluster's Python path.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import quire

    pkg = os.path.dirname(os.path.abspath(quire.__file__))
    root = os.path.dirname(pkg)
    target = os.path.join(tempfile.mkdtemp(prefix="quire-py-"), "quire.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(key)
