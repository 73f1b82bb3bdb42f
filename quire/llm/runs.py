"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are equal),
at least ``least_length`` words and ``least_exponent`` (4 or more) periods
long, that neither neighbour extends.

The words of a batch of documents are one sequence of numbers, in which every
document has numbers of its own, so that nothing matches across documents.

1. *Suffix array* by prefix doubling.  Round k tells which stretches of 2^k
   words are equal; only suffixes that are still tied take part in the next
   round, and the ranks of all rounds are kept.
2. *Dyadic blocks*.  A run of period q is at least 4q long, so it holds an
   aligned block of 2^k words, q < 2^k <= 2q, and a copy of that block q words
   further or q words earlier.  Blocks that occur once need no query.
3. *Range successor*.  The occurrences of a block are an interval of the suffix
   array.  A wavelet tree over the array gives the next and the previous one
   in log steps, for all blocks of the batch at once.  Occurrences that overlap
   are a progression, and the distance to the nearest is its step: the
   candidate period.
4. *Extension* to both sides by the kept ranks, longest stretches first.

Everything after splitting is numpy over whole batches: O(n log n) time, and
about 20 bytes a word and level.  A document is never cut; a batch is closed
once it has ``BATCH_WORDS`` words, so memory is that of a batch or of the
longest document.  Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.util import ship_package
from .common import text_or_empty

BATCH_WORDS = 1 << 17
LEAST_LENGTH = 6
LEAST_EXPONENT = 4

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SuffixArray:
    """Suffix array of a number sequence, with the ranks of every doubling round.

    ``ranks[k][i]`` is the first place in ``order`` of a suffix that begins with
    the same 2^k numbers as suffix i, ``sizes[k][i]`` how many do.
    """

    def __init__(self, numbers):
        import numpy as np

        n = len(numbers)
        self.order = np.argsort(numbers, kind="stable").astype(np.int64)
        rank, size = self._grouped(numbers[self.order], self.order, np.empty(n, np.int32), np.empty(n, np.int32), None)
        self.ranks, self.sizes, h = [rank], [size], 1
        while True:
            tied = np.flatnonzero(size[self.order] > 1)  # places of the order
            if not len(tied):
                return
            at = self.order[tied]
            beyond = at + h
            # What ends first is smaller; the place of the group keeps groups apart.
            follows = np.where(beyond < n, rank[np.minimum(beyond, n - 1)].astype(np.int64) + 1, 0)
            key = rank[at].astype(np.int64) * (n + 1) + follows
            by = np.argsort(key, kind="stable")
            self.order[tied] = at[by]
            rank, size = self._grouped(key[by], at[by], rank.copy(), size.copy(), tied)
            self.ranks.append(rank)
            self.sizes.append(size)
            h *= 2

    @staticmethod
    def _grouped(key, at, rank, size, places):
        """Ranks and sizes of the groups of equal neighbours in ``key``, set for the suffixes ``at``."""
        import numpy as np

        if not len(key):
            return rank, size
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        lengths = np.diff(np.append(first, len(key)))
        rank[at] = np.repeat(first if places is None else places[first], lengths)
        size[at] = np.repeat(lengths, lengths)
        return rank, size

    def ahead(self, i, j):
        """Lengths of the longest equal stretches that begin at i and j."""
        import numpy as np

        i, j, n = i.copy(), j.copy(), len(self.order)
        got = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[k]
            # Stretches of 2^k that are equal may repeat at the highest round.
            while True:
                open_ = (i < n) & (j < n)
                same = open_ & (rank[np.minimum(i, n - 1)] == rank[np.minimum(j, n - 1)])
                if not same.any():
                    break
                step = np.where(same, 1 << k, 0)
                i, j, got = i + step, j + step, got + step
        return got

    def behind(self, i, j):
        """Lengths of the longest equal stretches that end before i and j."""
        import numpy as np

        i, j = i.copy(), j.copy()
        got = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, h = self.ranks[k], 1 << k
            while True:
                a, b = i - h, j - h
                same = (a >= 0) & (b >= 0) & (rank[np.maximum(a, 0)] == rank[np.maximum(b, 0)])
                if not same.any():
                    break
                step = np.where(same, h, 0)
                i, j, got = i - step, j - step, got + step
        return got


class WaveletTree:
    """Wavelet tree (one bit row a level) over the numbers 0 to n-1 in any order."""

    def __init__(self, values):
        import numpy as np

        n = len(values)
        self.bits = max(1, int(n - 1).bit_length()) if n else 1
        self.zeros, self.starts, values = [], [], np.asarray(values, np.int64)
        for level in range(self.bits - 1, -1, -1):
            bit = (values >> level) & 1
            zeros = np.zeros(n + 1, np.int32)
            np.cumsum(1 - bit, out=zeros[1:])
            self.zeros.append(zeros)
            self.starts.append(int(zeros[-1]))
            values = np.concatenate((values[bit == 0], values[bit == 1]))

    def below(self, lo, hi, bound):
        """How many of the places lo to hi-1 hold a number below ``bound`` (bounds 0 to 2^bits - 1)."""
        import numpy as np

        count = np.zeros(len(lo), np.int64)
        lo, hi = lo.astype(np.int64), hi.astype(np.int64)
        for zeros, start, level in zip(self.zeros, self.starts, range(self.bits - 1, -1, -1), strict=True):
            one = ((bound >> level) & 1).astype(bool)
            a, b = zeros[lo].astype(np.int64), zeros[hi].astype(np.int64)
            count += np.where(one, b - a, 0)
            lo, hi = np.where(one, start + lo - a, a), np.where(one, start + hi - b, b)
        return count

    def smallest(self, lo, hi, k):
        """The k-th smallest number (from 0) of the places lo to hi-1."""
        import numpy as np

        value = np.zeros(len(lo), np.int64)
        lo, hi, k = lo.astype(np.int64), hi.astype(np.int64), k.astype(np.int64)
        for zeros, start, level in zip(self.zeros, self.starts, range(self.bits - 1, -1, -1), strict=True):
            a, b = zeros[lo].astype(np.int64), zeros[hi].astype(np.int64)
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            value |= np.where(one, 1 << level, 0)
            lo, hi = np.where(one, start + lo - a, a), np.where(one, start + hi - b, b)
        return value


def sequence_runs(numbers, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT):
    """``(start, length, period)`` arrays of all runs of a number sequence, by start, then period."""
    import numpy as np

    if least_exponent < 4:
        raise ValueError("blocks are sure to meet runs of four periods or more")
    n = len(numbers)
    none = np.empty(0, np.int64)
    if n < 2:
        return none, none, none
    sa = SuffixArray(numbers)
    blocks, levels, lo, hi = [], [], [], []
    for k in range(1, len(sa.ranks)):
        at = np.arange(0, n, 1 << k)
        at = at[sa.sizes[k][at] > 1]
        blocks.append(at)
        levels.append(np.full(len(at), k))
        lo.append(sa.ranks[k][at].astype(np.int64))
        hi.append(sa.ranks[k][at].astype(np.int64) + sa.sizes[k][at])
    if not sum(map(len, blocks)):
        return none, none, none
    at, level, lo, hi = map(np.concatenate, (blocks, levels, lo, hi))
    tree = WaveletTree(sa.order)
    here = tree.below(lo, hi, at)  # how many occurrences come before the block
    starts, steps = [], []
    for other, there in ((here + 1, here + 1 < hi - lo), (here - 1, here > 0)):
        found = tree.smallest(lo[there], hi[there], other[there])
        d = np.abs(found - at[there])
        # A period q is looked for with blocks of more than q and up to 2q words.
        good = (d < 1 << level[there]) & (2 * d >= 1 << level[there])
        starts.append(np.minimum(found, at[there])[good])
        steps.append(d[good])
    start, period = np.concatenate(starts), np.concatenate(steps)
    length = sa.ahead(start, start + period) + period
    back = sa.behind(start, start + period)
    start, length = start - back, length + back
    found = np.unique(np.stack((start, period, length), 1)[length >= np.maximum(least_length, least_exponent * period)], axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def words_of(text: str) -> list[bytes]:
    """Words: stretches without space, tab, LF, VT, FF or CR (UTF-8)."""
    return text.encode("utf-8", "surrogatepass").split()


def batch_runs(texts: Sequence[list[bytes]], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """Runs of each document (given as words): ``(start, length, period)``."""
    import numpy as np

    numbers: list[int] = []
    ends = []
    for words in texts:
        known: dict[bytes, int] = {}
        base = len(numbers)
        numbers.extend([known.setdefault(w, base + i) for i, w in enumerate(words)])
        ends.append(len(numbers))
    start, length, period = sequence_runs(np.array(numbers, np.int64), least_length, least_exponent)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    doc = np.searchsorted(ends, start, "right")
    firsts = [0, *ends]
    for d, s, n, q in zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True):
        out[d].append((s - firsts[d], n, q))
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by spaces."""
    if found:
        drop = bytearray(len(words))
        for s, n, q in found:
            drop[s + q : s + n] = b"\x01" * (n - q)
        words = [w for w, gone in zip(words, drop, strict=True) if not gone]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def find_runs(docs: DataFrame, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT, batch_words: int = BATCH_WORDS) -> DataFrame:
    """``(doc_id, runs, collapsed)``, one row per row of ``docs``.

    ``runs`` holds all runs by start, then period; ``collapsed`` is the text
    with each run cut to its first period, words joined by single spaces.  A
    null text counts as empty and has no runs.  Rows that repeat are told once
    each; other columns are not read; an empty table gives an empty result.
    """

    def find(batches: Iterator) -> Iterator:
        import pandas as pd

        def told(ids, texts):
            runs = batch_runs(texts, least_length, least_exponent)
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
            ids = pd.concat(ids, ignore_index=True)
            return pd.DataFrame({"doc_id": ids, "runs": pd.Series(rows, dtype=object), "collapsed": [collapsed(w, r) for w, r in zip(texts, runs, strict=True)]})

        for pdf in batches:
            # A null in a column of numbers would come as a float: the exact ids are kept apart.
            ids, texts, n, first = pdf["doc_id"], [], 0, 0
            for k, text in enumerate(pdf["text"]):
                texts.append(words_of(text))
                n += len(texts[-1])
                if n >= batch_words or k + 1 == len(pdf):
                    yield told([ids.iloc[first : k + 1]], texts)
                    texts, n, first = [], 0, k + 1

    ship_package(docs.sparkSession)
    # Ids travel as text, which keeps nulls and large numbers exact.
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"))
    found = rows.mapInPandas(find, f"doc_id string, runs {RUNS}, collapsed string")
    return found.select(F.col("doc_id").cast(kind).alias("doc_id"), "runs", "collapsed")


def planted(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with runs written into one document in ten.

    With h = crc32 of the decimal doc_id and g = h div 10, a document with
    h mod 10 = 0 and n > 0 words keeps its first a = g mod n words and repeats
    the next p = 1 + (n - a) div (3 + g mod 8) to its end.  Null doc_ids and
    texts are left as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    split = F.filter(F.split(text_or_empty(), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    d = docs.select("doc_id", "text", F.when(h % 10 == 0, split).alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w")
    d = d.select("doc_id", "text", "w", n.alias("n"), "g", F.when(n > 0, F.col("g") % n).cast("int").alias("a"))
    d = d.select("doc_id", "text", "w", "n", "a", F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)").alias("p"))
    again = F.expr("concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), CAST((n - a + p - 1) DIV p AS INT))), 1, n - a))")
    return d.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """``find_runs`` with the strongest run of each document and digests instead of lists and texts.

    The strongest run has the greatest exact length / period; ties go to the smallest start, then period.
    """
    d = find_runs(docs)
    # Cross multiplication compares the exponents exactly.
    ahead = "x.length * acc.period > acc.length * x.period"
    best = F.expr(f"aggregate(runs, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>), (acc, x) -> CASE WHEN acc IS NULL OR {ahead} THEN x ELSE acc END)")
    lines = F.expr("array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')), '')")
    d = d.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("b"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return d.select(
        "doc_id", "n_runs", F.col("b.start").alias("start"), F.col("b.length").alias("length"), F.col("b.period").alias("period"),
        F.expr("1000 * b.length DIV b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
