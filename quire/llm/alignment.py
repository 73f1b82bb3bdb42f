"""Alignment of two tokenizers' tokens, in lockstep over whole batches.

Tokenizer A encodes a space and the text, tokenizer B the text (and puts the
space there itself), so both cover the same bytes.  Where a token of A and one
of B end together there is a *cut*: it closes a group, and the two tokens are
*linked*.

The merge of the two sequences of token ends runs for all documents of a batch
at once.  One state vector holds, for every lane, the next token of A and of B;
each step compares the two ends of every lane, emits the cuts and links it
finds, moves the pointer that is behind (both at a cut), and leaves out the
lanes that are done.  A document is a lane; a long one is several, parted at
cuts that are verified first, so that the number of steps does not follow the
longest document.

Both tokenizers encode a text chunk by chunk (``tokenization``), mostly the
same chunks, so every chunk ends in a cut and a text's groups are those of its
chunks in order.  Chunks repeat: a Python worker brings each new one into
lockstep with the others of its batch and keeps its tokens in the order of
their groups, in two generations of ``ALIGNED_CHUNKS`` / 2.  Texts that one tokenizer encodes
whole, or with a chunk that its tokens do not spell, are aligned whole.

Links are counted over the corpus by a grouped sum.  Two linked tokens end
together, so the bytes of one end in those of the other: a vocabulary entry has
at most as many partners as bytes, and the table of pairs is bounded by the two
vocabularies (``most_pairs``) whatever the corpus.  That table is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.util import ship_package
from .common import stored, text_or_empty
from .tokenization import Chunked, load, tokenizer_path

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
BATCH_BYTES = 1 << 20
LANE_BYTES = 1024  # a longer document is parted into lanes of about this size
TRIES = 32  # tokens looked at for a cut where a lane should end
ALIGNED_CHUNKS = 400_000  # chunks whose aligned tokens a Python worker keeps (about 80 MB)
ENCODED_CHUNKS = 100_000, 1_000  # and those its tokenizers keep; A's put words with marks together

_LOADED: dict[tuple[str, str], "Aligner"] = {}


def most_pairs(a: Sequence[bytes], b: Sequence[bytes]) -> int:
    """How many pairs of entries can end together: one is a suffix of the other."""
    known_a, known_b = set(a) - {b""}, set(b) - {b""}
    shorter_b = sum(t[k:] in known_b for t in known_a for k in range(len(t)))
    return shorter_b + sum(t[k:] in known_a for t in known_b for k in range(1, len(t)))


def lanes(ends_a, ends_b, docs_a, lane_bytes: int = LANE_BYTES):
    """Ends of lanes as numbers of tokens ``(of A, of B)``: every document's end, and cuts inside long ones."""
    import numpy as np

    stops = ends_a[docs_a - 1]  # byte ends of the documents, none of them empty
    starts = np.concatenate(([0], stops[:-1]))
    parts = (stops - starts) // lane_bytes
    of = np.repeat(np.arange(len(stops)), parts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts) + 1
    at = np.searchsorted(ends_a, starts[of] + nth * lane_bytes)
    found = [stops]
    for _ in range(TRIES):
        at = at[at < len(ends_a)]
        if not len(at):
            break
        byte = ends_a[at]
        good = ends_b[np.minimum(np.searchsorted(ends_b, byte), len(ends_b) - 1)] == byte
        found.append(byte[good])
        at = at[~good] + 1
    bytes_ = np.unique(np.concatenate(found))
    return np.searchsorted(ends_a, bytes_) + 1, np.searchsorted(ends_b, bytes_) + 1


def lockstep(ends_a, ends_b, lane_a, lane_b):
    """Marks of the tokens of A and of B that end at a cut; lanes end at ``lane_a`` and ``lane_b``."""
    import numpy as np

    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    a, b = np.concatenate(([0], lane_a[:-1])), np.concatenate(([0], lane_b[:-1]))
    stop = lane_a
    while len(a):
        byte_a, byte_b = ends_a[a], ends_b[b]
        cut = byte_a == byte_b
        cut_a[a[cut]] = True
        cut_b[b[cut]] = True
        a, b = a + (byte_a <= byte_b), b + (byte_b <= byte_a)
        # Both sides of a lane end in a cut, so A's pointer tells when it is done.
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    return cut_a, cut_b


def _spelled(ids, counts, wanted: list[bytes], vocabulary: list[bytes], blob, lengths):
    """Whether the bytes of each text's tokens, joined, are those wanted; ``counts``: tokens of each text."""
    import numpy as np

    if not len(ids):
        return np.array([not w for w in wanted], bool)
    size = lengths[ids]
    ends = np.cumsum(size)
    # Place of each byte in the vocabulary's bytes: that of its token and how far it is in it.
    first = (np.cumsum(lengths) - lengths)[ids] - (ends - size)
    stops = np.cumsum(counts)
    if blob[np.arange(ends[-1]) + np.repeat(first, size)].tobytes() == b"".join(wanted):
        if (np.concatenate(([0], ends))[stops] == np.cumsum(np.fromiter(map(len, wanted), np.int64, len(wanted)))).all():
            return np.ones(len(wanted), bool)
    parts = np.split(ids, stops[:-1])
    return np.array([b"".join(map(vocabulary.__getitem__, x.tolist())) == w for x, w in zip(parts, wanted, strict=True)], bool)


class Aligner(Chunked):
    """Encodes batches with both tokenizers and aligns them; keeps the aligned tokens of chunks."""

    def __init__(self, path_a: str, path_b: str):
        import numpy as np
        import pyarrow as pa

        super().__init__({}, ALIGNED_CHUNKS)
        self.a, self.b = load(path_a, "byte", True, ENCODED_CHUNKS[0]), load(path_b, "piece", False, ENCODED_CHUNKS[1])
        self.bytes_a, self.bytes_b = self.a.vocabulary(), self.b.vocabulary()
        self._len_a, self._len_b = (np.array([len(t) for t in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        self._blob_a, self._blob_b = (np.frombuffer(b"".join(v), np.uint8) for v in (self.bytes_a, self.bytes_b))
        self._most = max(len(self.bytes_a), len(self.bytes_b))
        self._told = pa.array([f"{k}{mark}" for mark in (",", "|", ";", "") for k in range(self._most)], pa.string())

    def align(self, texts: Sequence[str]) -> list[tuple]:
        """``(ids of A, ids of B, groups, links)`` per text; links are ``a * |B| + b``."""
        import numpy as np

        shown = self._whole_texts(texts)
        _, _, groups, links, ends = self._told_of(shown)
        return [(*self._ids(s), *row) for s, *row in zip(shown, groups.to_pylist(), np.split(links, ends[:-1]) if texts else [], strict=True)]

    def rows(self, texts: Sequence[str]) -> tuple:
        """Numbers of tokens of A and of B, groups, links and their ends of all texts, as arrays; mostly by way of the texts' chunks."""
        cut = [self.b.chunks(t) for t in texts]  # A cuts these texts at the same places
        met = [None if chunks is None else list(map(self._cache.get, chunks)) for chunks in cut]
        missing = {c for chunks, parts in zip(cut, met, strict=True) if parts and None in parts for c, p in zip(chunks, parts, strict=True) if p is None}
        cache = self._met([missing])
        out, whole = [b""] * len(texts), []
        for k, parts in enumerate(met):
            if parts and None in parts:
                parts = [cache[c] if p is None else p for c, p in zip(cut[k], parts, strict=True)]
            if parts is None or False in parts:
                whole.append(k)
            else:
                out[k] = b"".join(parts)
        for k, shown in zip(whole, self._whole_texts([texts[k] for k in whole]), strict=True):
            out[k] = shown
        return self._told_of(out)

    def _learn(self, missing: Iterable[str]) -> None:
        """Put the aligned tokens of chunks into the cache, False for one that its tokens do not spell."""
        new = list(missing)
        self._cache.update(zip(new, self._aligned(new, self.a.encode_chunks(new), self.b.encode_chunks(new)), strict=True))

    def _whole_texts(self, texts: Sequence[str]) -> list[bytes]:
        """``_aligned`` of whole texts and a space before each; nothing where there are no tokens."""
        known = [k for k, t in enumerate(texts) if t]
        spaced = [" " + texts[k] for k in known]
        out = [b""] * len(texts)
        for k, shown in zip(known, self._aligned(spaced, self.a.encode(spaced), self.b.encode([texts[k] for k in known])), strict=True):
            out[k] = shown or b""
        return out

    def _aligned(self, texts: Sequence[str], told_a: Sequence[bytes], told_b: Sequence[bytes]) -> list[bytes | bool]:
        """The tokens of A and B (given as bytes) in the order of the groups, as 32-bit places in ``_told``; False where a side does not spell the text."""
        import numpy as np

        if not texts:
            return []
        wanted = [t.encode("utf-8", "surrogatepass") for t in texts]
        ids_a, ids_b = (np.frombuffer(b"".join(told), "<u4").astype(np.int64) for told in (told_a, told_b))
        n_a, n_b = (np.fromiter(map(len, told), np.int64, len(texts)) // 4 for told in (told_a, told_b))
        good = _spelled(ids_a, n_a, wanted, self.bytes_a, self._blob_a, self._len_a) & _spelled(ids_b, n_b, wanted, self.bytes_b, self._blob_b, self._len_b)
        if not good.all():
            ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
            n_a, n_b = n_a * good, n_b * good
        shown = np.empty(0, np.int64)
        if len(ids_a):
            ends_a, ends_b = np.cumsum(self._len_a[ids_a]), np.cumsum(self._len_b[ids_b])
            docs_a = np.cumsum(n_a)[n_a > 0]
            cut_a, cut_b = lockstep(ends_a, ends_b, *lanes(ends_a, ends_b, docs_a))
            shown = self._shown(ids_a, ids_b, cut_a, cut_b, np.flatnonzero(cut_a), np.flatnonzero(cut_b))
        told, ends = shown.astype("<i4").tobytes(), (4 * np.cumsum(n_a + n_b)).tolist()
        return [told[start:end] if ok else False for ok, start, end in zip(good.tolist(), [0, *ends[:-1]], ends, strict=True)]

    def _told_of(self, shown: Sequence[bytes]) -> tuple:
        """Numbers of tokens of A and of B, groups, links and their ends of aligned texts, as arrays."""
        import numpy as np
        import pyarrow as pa

        every = np.frombuffer(b"".join(shown), "<i4")
        ends = np.cumsum(np.fromiter(map(len, shown), np.int64, len(shown))) // 4
        starts = np.concatenate(([0], ends[:-1]))
        mark = every // self._most
        last_a, last_b = mark == 1, mark == 2  # of a group
        links = (every[last_a].astype(np.int64) - self._most) * len(self.bytes_b) + every[last_b] - 2 * self._most
        link_ends = np.concatenate(([0], np.cumsum(last_b)))[ends]
        n_b = np.diff(np.concatenate(([0], np.cumsum(self._of_b(last_a, last_b))))[ends], prepend=0)
        places = every.copy()
        places[ends[starts < ends] - 1] += self._most  # no mark behind the last
        spelled = self._told.take(pa.array(places))
        bounds = np.frombuffer(spelled.buffers()[1], np.int32)[np.concatenate(([0], ends))] if len(places) else np.zeros(len(shown) + 1, np.int32)
        groups = pa.StringArray.from_buffers(len(shown), pa.py_buffer(bounds.tobytes()), spelled.buffers()[2] or pa.py_buffer(b""))
        return ends - starts[: len(ends)] - n_b, n_b, groups, links, link_ends

    def _ids(self, shown: bytes):
        """The ids of A and of B of one aligned text."""
        import numpy as np

        every = np.frombuffer(shown, "<i4").astype(np.int64)
        mark = every // self._most
        of_b = self._of_b(mark == 1, mark == 2)
        return (every % self._most)[~of_b], (every % self._most)[of_b]

    @staticmethod
    def _of_b(last_a, last_b):
        """Which tokens are of B: those behind the last of A in their group, to the last of B."""
        import numpy as np

        return np.cumsum(last_a) - last_a > np.cumsum(last_b) - last_b

    def _shown(self, ids_a, ids_b, cut_a, cut_b, at_a, at_b):
        """The tokens of both in the order of the groups, as places in ``_told``: id and the mark after it."""
        import numpy as np

        # A token goes behind all tokens of earlier groups; B's behind those of A in its group too.
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        out = np.empty(len(ids_a) + len(ids_b), np.int64)
        out[np.arange(len(ids_a)) + np.concatenate(([0], at_b + 1))[group_a]] = ids_a + self._most * cut_a
        out[np.arange(len(ids_b)) + (at_a + 1)[group_b]] = ids_b + 2 * self._most * cut_b
        return out


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Aligner(path_a, path_b)
    return _LOADED[path_a, path_b]


def align(docs: DataFrame, tokenizer_a: str | None = None, tokenizer_b: str | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``(doc_id, n_a, n_b, groups, links)``, one row per row of ``docs``.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: decimal ids of A and B per group.
    ``links`` are ids ``a * |B| + b``, one per cut, in order.  A text that is
    null or empty, or whose tokens of A or B do not spell a space and the text,
    has no tokens: zeros, '' and no links.  Rows that repeat are aligned once
    each; columns other than doc_id and text are not read; an empty table gives
    an empty result.
    """
    path_a, path_b = tokenizer_a or tokenizer_path(TOKENIZER_A), tokenizer_b or tokenizer_path(TOKENIZER_B)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        both = aligner(path_a, path_b)
        for batch in batches:
            ids, told = batch.columns
            texts, n, first = [], 0, 0
            for k, text in enumerate(told):
                texts.append(text.as_py())
                n += len(texts[-1])
                if n >= batch_bytes or k + 1 == len(told):
                    n_a, n_b, groups, links, ends = both.rows(texts)
                    ends = pa.array(np.concatenate(([0], ends)), pa.int32())
                    yield pa.RecordBatch.from_arrays([
                        ids[first : k + 1], pa.array(n_a), pa.array(n_b), groups, pa.ListArray.from_arrays(ends, pa.array(links)),
                    ], ["doc_id", "n_a", "n_b", "groups", "links"])
                    texts, n, first = [], 0, k + 1

    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Ids travel as text, which keeps nulls and large numbers exact.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"))
    out = rows.mapInArrow(run, "doc_id string, n_a bigint, n_b bigint, groups string, links array<bigint>")
    return out.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_a", "n_b", "groups", "links")


def link_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``(link, n, best)``: how often each pair is linked in the corpus, and whether no pair of its B id is linked more often."""
    counts = stored(aligned.select(F.explode("links").alias("link")).groupBy("link").agg(F.count(F.lit(1)).alias("n")), "link-counts")
    most = counts.groupBy((F.col("link") % size_b).alias("b")).agg(F.max("n").alias("most"))
    return stored(counts.withColumn("b", F.col("link") % size_b).join(most, "b").select("link", "n", (F.col("n") == F.col("most")).alias("best")), "links")


def alignment_digests(docs: DataFrame) -> DataFrame:
    """Per document counts, a digest of its groups, and the corpus-wide counts of its links."""
    size_b = len(load(tokenizer_path(TOKENIZER_B), "piece").vocabulary())
    sha = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    aligned = stored(
        align(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", F.size("links").cast("bigint").alias("n_links"), sha.alias("groups_sha256"), "links"),
        "aligned",
    )
    # At most ``most_pairs`` rows, a number the vocabularies fix.
    counts = F.broadcast(link_counts(aligned, size_b))
    sums = (
        aligned.select("row", F.explode("links").alias("link")).join(counts, "link")
        .groupBy("row").agg(F.sum(F.col("best").cast("bigint")).alias("n_best"), F.sum("n").alias("count_sum"))
    )
    zero = F.lit(0).cast("bigint")
    return aligned.drop("links").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
