"""Exact dedup by deterministic block naming (Karp, Miller and Rosenberg).

A text is cut into blocks of ``block_bytes`` bytes (UTF-8).  The distinct
blocks are sorted and numbered: equal blocks, and only these, get one integer
name.  Then adjacent names are paired and the distinct pairs are numbered in
the same way, level by level, until every document has one name.  Two texts
are equal exactly when they finish on the same level with the same name: the
names come from comparing contents, so there are no collisions to fear.

Shape at scale.  The text is shuffled once, after each map task has removed
its own repeats.  Blocks travel to their group by a 64-bit address, and the
rows that ask for names carry only that address: eight bytes instead of a
block.  An address is never an identity.  Should two different blocks share
one, both are named by content, and the rows of that address are matched by
content in a second join (``address`` is a parameter so that tests can force
this).  A block that fills a third of the table is merged in the map tasks; the
joins that hand names back have plain light exchanges on both sides, which AQE
splits when skewed.  The number of levels is log2 of the most blocks in a text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored, text_or_empty

BLOCK_BYTES = 8192


def _blocks(bin_col: str, block_bytes: int) -> Column:
    """The blocks of a binary column; one empty block for an empty text."""
    last = F.greatest(F.ceil(F.octet_length(bin_col) / F.lit(block_bytes)), F.lit(1)).cast("int") - 1
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.substring(F.col(bin_col), i * block_bytes + 1, F.lit(block_bytes)),
    )


def _numbered(distinct: DataFrame, by: list[str]) -> DataFrame:
    """Distinct rows with integer names in sorted order: partition number and rank in the sorted partition."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def _name_blocks(rows: DataFrame, contents: DataFrame) -> DataFrame:
    """``rows`` (with ``addr``) plus the name of the block at ``(row, pos)``.

    contents: ``(row, pos, addr, block)`` of the same rows; its blocks are read only to build the
    names and to settle shared addresses.
    """
    sets = contents.groupBy("addr").agg(F.collect_set("block").alias("blocks"))
    each = sets.select("addr", (F.size("blocks") > 1).alias("shared"), F.explode("blocks").alias("block"))
    names = stored(
        _numbered(each, ["block"]).select("addr", "shared", "name", F.when(F.col("shared"), F.col("block")).alias("block")),
        "block-names",
    )
    named = rows.join(names.where(~F.col("shared")).select("addr", "name"), "addr")
    shared = names.where("shared").select("addr", "block", "name")
    if shared.take(1):
        told = contents.join(shared, ["addr", "block"]).select("row", "pos", "name")
        named = named.unionByName(rows.join(told, ["row", "pos"]).select(*named.columns))
    return named


def name_texts(texts: DataFrame, block_bytes: int = BLOCK_BYTES, address: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``(row, level, name)`` for ``texts`` ``(row, text, ...)``; ``(level, name)`` is equal exactly for equal texts.

    ``row`` has to be unique and stored (not computed anew on each read).  Other columns are carried.
    """
    carried = [c for c in texts.columns if c not in ("row", "text")]
    bins = texts.select("row", *carried, F.col("text").cast("binary").alias("bin"))
    cut = bins.select("row", *carried, _blocks("bin", block_bytes).alias("blocks"))
    contents = cut.select("row", F.posexplode("blocks").alias("pos", "block")).select(
        "row", "pos", address(F.col("block")).alias("addr"), "block"
    )
    # What belongs to a whole text is carried by its first block only.
    first = [F.when(F.col("pos") == 0, F.col(c)).alias(c) for c in carried]
    rows = cut.select(
        "row", *carried, F.size("blocks").alias("left"), F.posexplode(F.transform("blocks", lambda b: address(b))).alias("pos", "addr")
    ).select("row", "pos", "left", "addr", *first)
    level = 0
    current = stored(_name_blocks(rows, contents).select("row", "pos", "left", "name", *carried), "named-0")
    done = current.where("left = 1").select("row", F.lit(0).alias("level"), "name", *carried)
    most = current.agg(F.max("left")).first()[0] or 1
    while most > 1:
        level += 1
        pairs = (
            current.where("left > 1")
            .groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("half"))
            .agg(
                F.max("left").alias("left"),
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                # An odd last name has no partner: -1 is no name.
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
                *[F.max(c).alias(c) for c in carried],
            )
        )
        pairs = stored(pairs, f"pairs-{level}")
        names = stored(_numbered(pairs.select("a", "b").distinct(), ["a", "b"]), f"pair-names-{level}")
        current = stored(
            pairs.join(names, ["a", "b"]).select(
                "row", F.col("half").alias("pos"), F.ceil(F.col("left") / 2).cast("int").alias("left"), "name", *carried
            ),
            f"named-{level}",
        )
        done = done.unionByName(current.where("left = 1").select("row", F.lit(level).alias("level"), "name", *carried))
        most = (most + 1) // 2
    return done


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES, address: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``.

    Of rows with equal texts the one with the largest doc_id stays.  A null
    text counts as empty; a null doc_id is the smallest.  Where rows repeat
    the doc_id as well, one of them stays.  Columns other than doc_id and text
    are not read.  An empty table gives an empty result.
    """
    d = docs.select(F.col("doc_id"), text_or_empty().alias("text"))
    row = F.monotonically_increasing_id().alias("row")
    # The digest is 32 bytes in the shuffles and hexadecimal only at the end.
    texts = d.select(row, "doc_id", "text", F.unhex(F.sha2("text", 256)).alias("sha"))
    named = name_texts(texts, block_bytes, address)
    groups = named.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # One row stays even where several have the largest doc_id of their group.
    last = named.groupBy("level", "name", "doc_id").agg(F.max("row").alias("row")).select("row", F.lit(True).alias("last"))
    return (
        named.join(groups, ["level", "name"])
        .join(last, "row", "left")
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("last").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        )
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Pipeline stage: ``docs`` without the rows whose text another, kept row has.

    All columns are returned as they are.  Null texts count as empty, and one empty text stays.
    """
    sha = fresh(docs.columns, "sha")
    ident = fresh([*docs.columns, sha], "ident")
    kept = exact_duplicates(docs).where("kept").select(F.col("doc_id").alias(ident), F.col("text_sha256").alias(sha))
    tagged = docs.withColumn(sha, F.sha2(text_or_empty(), 256))
    same = tagged["doc_id"].eqNullSafe(kept[ident]) & (tagged[sha] == kept[sha])
    return tagged.join(kept, same, "left_semi").dropDuplicates(["doc_id", sha]).drop(sha)
