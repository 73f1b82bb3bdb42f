"""Text codec of the index: ``Documents`` strings ``doc:tf, doc:tf`` per word.

Two forms: a *merged* index has champion lists in rank order and prints the
full value of tf; a *partial* index has no ranks yet, lists every posting of
one batch of documents, and prints six decimals.  Both encoders collect bounded
lists: at most ``top_n`` postings per term, or one batch of documents per term.
Decoding splits on the *last* colon, so names that contain colons survive;
entries without a colon or whose tf is not a number are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TF_FORMAT = "%.6f"  # fixed value: six decimals, as in the partial index files
ITEM_SEP = ", "
POSTING = r"^(.*):([^:]*)$"
PARTS = 16  # parts of a batch of documents in partial indexes
LINE_BREAKS = r"[\n\r\x{85}\x{2028}\x{2029}]"


def full_text(x) -> Column:
    """A double as text the way it is printed in full: shortest digits, positional from 1e-4 on
    (``0.0125``, ``0.0005``), below with a two-digit exponent (``1e-05``)."""
    s = (F.col(x) if isinstance(x, str) else x).cast("string")
    parts = r"^(-?)([0-9])\.([0-9]+)E-([0-9]+)$"
    sign, lead, rest = (F.regexp_extract(s, parts, k) for k in (1, 2, 3))
    exp = F.regexp_extract(s, parts, 4).cast("int")
    frac = F.when(rest == "0", F.lit("")).otherwise(rest)
    positional = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), exp - 1), lead, frac)
    scientific = F.concat(sign, lead, F.when(frac == "", F.lit("")).otherwise(F.concat(F.lit("."), frac)), F.lit("e-"), F.when(exp < 10, F.lit("0")).otherwise(F.lit("")), exp.cast("string"))
    return F.when(s.rlike(parts), F.when(exp <= 4, positional).otherwise(scientific)).otherwise(s)


def six_decimals(x) -> Column:
    """A double as ``TF_FORMAT`` prints it; by way of a decimal, which is cheaper than a formatter, where that is the same."""
    col = F.col(x) if isinstance(x, str) else x
    plain = (col > 0) & (col < 1e12)
    return F.when(plain, col.cast("decimal(20,6)").cast("string")).otherwise(F.format_string(TF_FORMAT, col))


def encode_postings(champs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(word, documents)`` of champion lists in rank order, full tf values."""
    if "rank" not in champs.columns:
        raise ValueError("champion lists have a rank; use encode_partials for partial indexes")
    items = F.array_sort(F.collect_list(F.struct("rank", F.concat(F.col(key).cast("string"), F.lit(":"), full_text("tf")).alias("item"))))
    return champs.groupBy(F.col("term").alias("word")).agg(F.array_join(F.transform(items, lambda s: s["item"]), ITEM_SEP).alias("documents"))


def encode_partials(postings: DataFrame, batch: str, key: str = "doc_id", parts: int = PARTS) -> DataFrame:
    """A1/G4 for partial indexes: ``(batch, word, documents)``, six-decimal tf.

    ``batch`` is required: a list holds the documents of one batch, which the caller sizes.  The words of a batch are
    dealt to ``parts`` parts, and a task gets whole parts: postings are shuffled once, as they are, and what is written
    by batch has a file a part.  Their text, three times as long, is made after that.
    """
    dealt = postings.select(
        F.col(batch), F.col("term").alias("word"), F.col(key).alias("_k"), F.col("tf").alias("_tf"),
        F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int").alias("_part"),
    ).repartition(F.col(batch), F.col("_part"))
    items = F.array_sort(F.collect_list(F.struct((-F.col("_tf")).alias("o"), F.col("_k").alias("k"))))
    lists = dealt.groupBy(batch, "_part", "word").agg(items.alias("items"))
    text = F.transform("items", lambda s: F.concat(s["k"].cast("string"), F.lit(":"), six_decimals(-s["o"])))
    return lists.select(batch, "word", F.array_join(text, ITEM_SEP).alias("documents"))


def decode_postings(encoded: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``(term, rank, doc_id STRING, tf DOUBLE, *carry)``; malformed entries dropped.

    ``rank`` counts the well-formed entries of a row in order: the champion rank
    of a merged index (of no meaning for a partial one).
    """

    def plainly(item: Column) -> Column:
        tf = F.substring_index(item, ":", -1)
        # Without a colon the whole item is left of it: no tf.
        name = F.left(item, F.char_length(item) - F.char_length(tf) - 1)
        return F.struct(name.alias("doc_id"), F.when(item.contains(":"), tf).try_cast("double").alias("tf"))

    def by_pattern(item: Column) -> Column:
        return F.struct(
            F.regexp_extract(item, POSTING, 1).alias("doc_id"),
            F.when(item.rlike(POSTING), F.regexp_extract(item, POSTING, 2)).try_cast("double").alias("tf"),
        )

    # The pattern ends at line breaks; lists without any are taken apart without it.
    items = F.split("documents", ITEM_SEP)
    parsed = F.when(F.col("documents").rlike(LINE_BREAKS), F.transform(items, by_pattern)).otherwise(F.transform(items, plainly))
    good = F.filter(parsed, lambda p: p["tf"].isNotNull() & (F.length(p["doc_id"]) > 0))
    return encoded.select(F.col("word").alias("term"), *carry, F.posexplode(good).alias("pos", "p")).select(
        "term", (F.col("pos") + 1).alias("rank"), F.col("p.doc_id").alias("doc_id"), F.col("p.tf").alias("tf"), *carry
    )
