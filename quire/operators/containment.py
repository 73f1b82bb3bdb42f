"""Which documents contain which passages verbatim -- without pairing every document
with every passage.

Candidate pairs come from an equi-join on fingerprints (winnowing: Schleimer,
Wilkerson, Aiken, SIGMOD 2003).  Each text is hashed into q-grams of code
points; in every window of ``w`` consecutive q-grams the smallest hash is a
fingerprint.  A passage of length ``L >= q + w - 1`` contained in a document
shares all its windows with the document, so each of its fingerprints is a
fingerprint of the document too: the join cannot miss a true pair.  A shorter
passage of length ``L`` uses its own scheme (``q' = min(q, L)``,
``w' = L - q' + 1``: the passage is exactly one window), so every passage is
covered exactly; documents are fingerprinted once per scheme present.

Documents keep only fingerprints some passage has: a semi join with the
written passage fingerprints, whose bytes tell Spark whether to broadcast them.  Each passage is then joined through its *rarest*
fingerprint only (document frequency counted over the kept fingerprints), so
a passage made of common text does not fan out through its commonest q-gram.  Every candidate is then verified
with an exact ``contains``.  Hashing runs in ``mapInArrow`` with numpy over
slices of Arrow batches; the joins, counts and verification are Spark operators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import ship_package, stored

Q = 16  # q-gram length in code points
W = 32  # window length in q-grams

_BASE = np.uint64(0x100000001B3)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)

ROWS_AT_ONCE = 128  # texts a task turns into Python objects at a time

FP_SCHEMA = "scheme INT, h BIGINT, id BIGINT"


def scheme_for(length: int, q: int = Q, w: int = W) -> tuple[int, int]:
    """(q, w) used for a passage of ``length`` code points."""
    if length >= q + w - 1:
        return q, w
    qq = min(q, length)
    return qq, length - qq + 1


def scheme_id(q: int, w: int) -> int:
    return q * 100_000 + w


def _qgram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Polynomial hashes of all q-grams, mixed; those of 2a code points come from two of a."""
    n = codes.shape[0] - q + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h, a = codes.copy(), 1
    with np.errstate(over="ignore"):
        for bit in bin(q)[3:]:
            h, a = h[:-a] * np.uint64(pow(int(_BASE), a, 1 << 64)) + h[a:], 2 * a
            if bit == "1":
                h, a = h[:-1] * _BASE + codes[a:], a + 1
        h ^= h >> np.uint64(30)
        h *= _M1
        h ^= h >> np.uint64(27)
        h *= _M2
        h ^= h >> np.uint64(31)
    return h


def fingerprints(text: str, q: int, w: int) -> np.ndarray:
    """Distinct winnowing fingerprints of ``text`` (uint64)."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    h = _qgram_hashes(codes, q)
    if h.shape[0] < w:
        return np.empty(0, dtype=np.uint64)
    least = sliding_min(h, w)
    # Neighbouring windows mostly share theirs: what is sorted is one of each run.
    return np.unique(least[np.concatenate([[True], least[1:] != least[:-1]])])


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of ``w`` consecutive values, in O(n) (block prefix/suffix minima)."""
    if w == 1:
        return h
    n = h.shape[0]
    m = n - w + 1
    pad = (-n) % w
    if pad:
        h = np.concatenate([h, np.full(pad, np.iinfo(np.uint64).max, dtype=np.uint64)])
    blocks = h.reshape(-1, w)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:m], prefix[w - 1 : w - 1 + m])


def _prints(schemes_of):
    """Arrow batches ``(id, text)`` -> fingerprints, ``ROWS_AT_ONCE`` texts at a time: what a task holds as Python
    objects is some texts and their prints, whatever the size of its batches."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(at, ROWS_AT_ONCE)
                out_s, out_h, out_id = [], [], []
                for ident, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    if not text:
                        continue
                    for qq, ww in schemes_of(text):
                        fp = fingerprints(text, qq, ww)
                        if fp.shape[0]:
                            out_s.append(np.full(fp.shape[0], scheme_id(qq, ww), dtype=np.int32))
                            out_h.append(fp.view(np.int64))
                            out_id.append(np.full(fp.shape[0], ident, dtype=np.int64))
                if out_h:
                    columns = [np.concatenate(c) for c in (out_s, out_h, out_id)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["scheme", "h", "id"])

    return fn


def _passage_fps(passages: DataFrame, q: int, w: int) -> DataFrame:
    return passages.select("pid", "ptext").mapInArrow(_prints(lambda text: [scheme_for(len(text), q, w)]), FP_SCHEMA)


def _document_fps(docs: DataFrame, schemes: list[tuple[int, int]]) -> DataFrame:
    """Document fingerprints per scheme."""
    return docs.select("did", "dtext").mapInArrow(_prints(lambda text: schemes), FP_SCHEMA)


def contained_pairs(
    docs: DataFrame,
    passages: DataFrame,
    doc_key: str = "doc_id",
    doc_text: str = "text",
    passage_key: str = "item_id",
    passage_text: str = "text",
    q: int = Q,
    w: int = W,
) -> DataFrame:
    """``(passage_key, doc_key)`` for every document whose text contains the passage.

    Keys must be integral.  Empty or null passages match nothing.
    """
    ship_package(docs.sparkSession)
    p = passages.select(F.col(passage_key).cast("bigint").alias("pid"), F.col(passage_text).alias("ptext")).where(
        F.length("ptext") > 0
    )
    d = docs.select(F.col(doc_key).cast("bigint").alias("did"), F.col(doc_text).alias("dtext"))

    # One small action on the passages: the short lengths in use (at most
    # q + w - 2 distinct values) decide the fingerprint schemes.
    short = F.when(F.length("ptext") < q + w - 1, F.length("ptext"))
    lengths = p.agg(F.collect_set(short).alias("short")).first()["short"]
    schemes = sorted({scheme_for(n, q, w) for n in lengths} | {(q, w)})

    # What is written is read more than once, and its bytes decide the joins:
    # the passages' few fingerprints are broadcast when they are few indeed.
    pfp = stored(_passage_fps(p, q, w), "passage-prints")
    dfp = _document_fps(d, schemes)
    dfp_used = stored(dfp.join(pfp.select("scheme", "h").distinct(), ["scheme", "h"], "left_semi"), "document-prints")
    df_counts = dfp_used.groupBy("scheme", "h").agg(F.count(F.lit(1)).alias("dfreq"))
    # Rarest fingerprint of each passage (a fingerprint no document has -> no candidates).
    chosen = (
        pfp.join(df_counts, ["scheme", "h"], "left")
        .withColumn("_r", F.row_number().over(Window.partitionBy("id").orderBy(F.coalesce("dfreq", F.lit(0)).asc(), F.col("h").asc())))
        .where("_r = 1 AND dfreq > 0")
        .select("scheme", "h", F.col("id").alias("pid"))
    )
    cands = stored(dfp_used.join(chosen, ["scheme", "h"]).select(F.col("id").alias("did"), "pid").distinct(), "candidates")
    verified = cands.join(d, "did").join(p, "pid").where(F.contains(F.col("dtext"), F.col("ptext")))
    return verified.select(F.col("pid").alias(passage_key), F.col("did").alias(doc_key))
