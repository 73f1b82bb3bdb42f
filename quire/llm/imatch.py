"""I-Match document fingerprints with randomised lexicons.

A document's terms are the distinct lower-cased letter and digit runs of its
text.  Of these, the terms in a band of inverse document frequency form the
lexicon: those in at least ``MIN_SHARE`` and at most ``MAX_SHARE`` of all
documents (counted over all of them).  ``SUBSETS`` random subsets of the lexicon are drawn at
different rates by a hash of the term.  For each subset the document's terms
in it are sorted and hashed; the hashes side by side are the fingerprint.
Sparse subsets survive edits of long texts, dense ones tell short texts apart.

Size of what is broadcast: a lexicon term is in at least ``MIN_SHARE`` of the
documents, so the lexicon has at most (mean distinct terms) / ``MIN_SHARE``
terms, whatever the number of documents.

Texts are compared with their neighbours in doc_id order without a global
sort: quantiles of doc_id cut the ids into blocks, each block is one window
partition, and the first document of the block before is sent along
as a guest.  The text is shuffled once, by block; all that follows (exploding
the terms, the lexicon lookup, regrouping, neighbours) keeps that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_or_empty

MIN_SHARE = 0.001
MAX_SHARE = 0.1
RATES = (1 / 16, 1 / 64, 1 / 256, 1 / 1024)  # share of the lexicon in a subset
PER_RATE = 8
SUBSETS = PER_RATE * len(RATES)
BLOCK_DOCS = 1000
MOST_BLOCKS = 20_000  # cuts are literals of the plan; beyond this, blocks grow instead of their number
TOP_CELLS = 128  # cuts are searched in two steps of about this many


def terms(text: str) -> Column:
    """Distinct terms of a text, hashed to 64 bits."""
    words = F.split(F.lower(F.col(text)), "[^\\p{L}\\p{N}]+")
    return F.transform(F.array_remove(F.array_distinct(words), ""), lambda w: F.xxhash64(w))


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(term, df)``: documents with the term, partial sums in the map tasks."""
    return docs.select(F.explode(terms(text)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def subsets_of(term: str = "term") -> Column:
    """Numbers of the subsets a term is in; each is drawn by its own hash."""
    drawn = [
        F.when(F.pmod(F.xxhash64(F.lit(k), F.col(term)), F.lit(1 << 20)) < int(RATES[k // PER_RATE] * (1 << 20)), F.lit(k))
        for k in range(SUBSETS)
    ]
    return F.array_compact(F.array(*drawn))


def lexicon(docs: DataFrame, n_docs: int, text: str = "text") -> DataFrame:
    """``(term, subset)`` for the terms in the band; their number is bounded as said above."""
    low, high = max(2, -(-n_docs * MIN_SHARE // 1)), max(2, n_docs * MAX_SHARE)
    df = document_frequencies(docs, text).where((F.col("df") >= low) & (F.col("df") <= high))
    return df.select("term", F.explode(subsets_of("term")).alias("subset"))


def _hashed(terms_: Column) -> Column:
    """64-bit hash of a subset's terms in sorted order; 0 for none."""
    return F.when(F.size(terms_) == 0, F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.sort_array(terms_)))


def likeness(a: str, b: str) -> Column:
    """Equal hashes among the subsets in which either has terms; 1 when all are equal."""
    pairs = F.arrays_zip(F.col(a).alias("x"), F.col(b).alias("y"))
    used = F.size(F.filter(pairs, lambda p: (p["x"] != 0) | (p["y"] != 0)))
    same = F.size(F.filter(pairs, lambda p: (p["x"] != 0) & (p["x"] == p["y"])))
    return F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(same / used)


def _string(fp: str) -> Column:
    return F.array_join(F.transform(F.col(fp), lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _block(doc_id: Column, cuts: list[int]) -> Column:
    """Number of cuts below ``doc_id``: its block.  Cells of cuts first, then the cuts of one cell."""
    width = max(1, TOP_CELLS)
    arr = F.array(*[F.lit(c).cast("bigint") for c in cuts]) if len(cuts) <= width else None
    if arr is not None:
        return F.size(F.filter(arr, lambda c: c < doc_id))
    cells = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    ends = F.array(*[F.lit(c[-1]).cast("bigint") for c in cells])
    inner = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in c]) for c in cells])
    cell = F.size(F.filter(ends, lambda c: c < doc_id))
    # Above all cuts there is no cell to search.
    return cell * width + F.coalesce(F.size(F.filter(F.get(inner, cell), lambda c: c < doc_id)), F.lit(0)) - F.when(cell == len(cells), len(cells) * width - len(cuts)).otherwise(0)


def with_next(docs: DataFrame, n_docs: int, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``(block, guest, rank, doc_id, text, next_text)`` in descending doc_id order, cyclic.

    Partitioned by ``block``.  ``guest`` marks the first document of the next block, which is there
    only to be the last one's neighbour.
    """
    n_blocks = min(MOST_BLOCKS, max(1, -(-n_docs // block_docs)))
    steps = [k / n_blocks for k in range(1, n_blocks)]
    got = docs.agg(F.max("doc_id").alias("top"), F.percentile_approx("doc_id", F.array(*[F.lit(s) for s in steps]) if steps else F.array(F.lit(0.5)), F.lit(max(100, 20 * n_blocks))).alias("cuts")).first()
    # Every cut is a doc_id that occurs, the last one the largest: block b ends with document cuts[b].
    cuts = sorted({*(got["cuts"] or [] if steps else []), *([got["top"]] if got["top"] is not None else [])})
    n = max(1, len(cuts))
    block = F.coalesce(_block(F.col("doc_id"), cuts[:-1]), F.lit(0)) if n > 1 else F.lit(0)
    last = F.get(F.array(*[F.lit(c).cast("bigint") for c in cuts]), F.col("b")) if cuts else F.lit(None).cast("bigint")
    ends = F.col("doc_id").eqNullSafe(last)
    here = F.struct(F.col("b").alias("block"), F.lit(False).alias("guest"))
    there = F.struct(((F.col("b") + 1) % n).alias("block"), F.lit(True).alias("guest"))
    placed = docs.withColumn("b", block).select(
        "doc_id", "text", F.explode(F.when(ends, F.array(here, there)).otherwise(F.array(here))).alias("at")
    ).select(F.col("at.block").alias("block"), F.col("at.guest").alias("guest"), "doc_id", "text")
    w = Window.partitionBy("block").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    return placed.select("*", F.row_number().over(w).alias("rank"), F.lead("text").over(w).alias("next_text"))


def fingerprints(docs: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    One row per row of ``docs``.  The edited text has its last third replaced
    by the beginning of the next document's text (descending doc_id, after the
    last one the first).  Null texts count as empty, null doc_ids come last,
    rows that repeat a doc_id follow each other by text.  A text without terms
    of the lexicon has the hash of its lower-cased whole as its only hash.  All
    hashes have 64 bits; a fingerprint is the hexadecimal of its ``SUBSETS`` hashes.
    Other columns are not read; an empty table gives an empty result.
    """
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    n_docs = d.count()
    words = stored(lexicon(d, n_docs), "lexicon")
    third = F.expr("n_chars div 3")
    edited = F.expr("concat(substring(text, 1, CAST(n_chars - n_chars div 3 AS INT)), substring(next_text, 1, CAST(n_chars div 3 AS INT)))")
    pairs = (
        with_next(d, n_docs, block_docs)
        .withColumn("n_chars", F.char_length("text").cast("bigint"))
        .withColumn("edited", F.when(third > 0, edited).otherwise(F.col("text")))
    )
    document = ["block", "rank", "guest", "doc_id", "n_chars", "edited_sha256", "whole", "whole2"]
    both = pairs.withColumns({
        "edited_sha256": F.sha2("edited", 256), "own": terms("text"), "new": terms("edited"),
        "whole": F.xxhash64(F.lower("text")), "whole2": F.xxhash64(F.lower("edited")),
    })
    # One explode for both texts; bit 0: in the text, bit 1: in the edited text.
    flagged = both.select(
        *document,
        F.explode_outer(F.concat(
            F.transform(F.array_intersect("own", "new"), lambda t: F.struct(t.alias("term"), F.lit(3).alias("flag"))),
            F.transform(F.array_except("own", "new"), lambda t: F.struct(t.alias("term"), F.lit(1).alias("flag"))),
            F.transform(F.array_except("new", "own"), lambda t: F.struct(t.alias("term"), F.lit(2).alias("flag"))),
        )).alias("t"),
    ).select(*document, F.col("t.term").alias("term"), F.col("t.flag").alias("flag"))
    # A left join, so that documents without terms of the lexicon stay (with subset null).
    hashed = (
        flagged.join(F.broadcast(words), "term", "left")
        .groupBy(*document, "subset")
        .agg(
            F.collect_list(F.when(F.col("flag") != 2, F.col("term"))).alias("own"),
            F.collect_list(F.when(F.col("flag") != 1, F.col("term"))).alias("new"),
        )
        .select(*document, "subset", _hashed(F.col("own")).alias("own"), _hashed(F.col("new")).alias("new"))
    )
    zero = F.lit(0).cast("bigint")
    found = hashed.groupBy(*document).agg(
        F.array(*[F.coalesce(F.max(F.when(F.col("subset") == k, F.col("own"))), zero) for k in range(SUBSETS)]).alias("fp"),
        F.array(*[F.coalesce(F.max(F.when(F.col("subset") == k, F.col("new"))), zero) for k in range(SUBSETS)]).alias("fp2"),
    )
    none = F.array(*[zero] * (SUBSETS - 1))
    found = found.withColumns({
        fp: F.when(F.exists(fp, lambda h: h != 0), F.col(fp)).otherwise(F.concat(F.array(whole), none)) for fp, whole in (("fp", "whole"), ("fp2", "whole2"))
    })
    w = Window.partitionBy("block").orderBy("rank")
    return (
        found.withColumn("fp_next", F.lead("fp").over(w))
        .where(~F.col("guest"))
        .select(
            "doc_id", "n_chars", "edited_sha256",
            _string("fp").alias("fingerprint"), _string("fp2").alias("edited_fingerprint"),
            likeness("fp", "fp2").alias("near_edited"), likeness("fp", "fp_next").alias("near_next"),
        )
    )
