"""Packing token ids into training sequences: first-fit decreasing with a tournament tree.

Documents are dealt into random groups of about ``GROUP_DOCS`` (a hash of
doc_id and text, so that repeated runs agree).  Each group is packed on its own:

1. a document longer than a sequence gives whole sequences of its own and a rest;
2. rests go, longest first, into the first sequence with room.  A tournament
   tree over the capacities (every node holds the larger of its two children)
   finds it in log steps;
3. the emptiest sequences are then taken apart to fill gaps of ``MIN_CUT`` ids
   or more in the others, and what is left at last, less than one sequence, is
   cut into lengths that are powers of two, which need no padding.

The text is tokenized once and only ids are shuffled, once, keyed by group.  A
group has a bounded expected size whatever the table, so a task never holds
more than some hundred documents, and a lost executor costs the groups it held.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.util import ship_package
from .common import text_or_empty
from .tokenization import load, tokenizer_path

SEQUENCE = 4096
GROUP_DOCS = 512
MIN_CUT = 32  # smaller gaps are padded instead of filled with a cut piece
END_ID = 2
TOKENIZER = "word_bpe_49k.json"

Piece = tuple[int, int, int]  # document, start, length


class CapacityTree:
    """Tournament tree over the free room of bins; finds the first bin that takes a size."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1
        while self.leaves < max(bins, 1):
            self.leaves *= 2
        self.best = [room] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Take ``size`` from the first bin with that much room; returns the bin, or -1."""
        best, node = self.best, 1
        if best[1] < size:
            return -1
        while node < self.leaves:
            node *= 2
            if best[node] < size:
                node += 1
        found = node - self.leaves
        best[node] -= size
        while node > 1:
            node //= 2
            best[node] = max(best[2 * node], best[2 * node + 1])
        return found


def _top_up(bins: list[list[Piece]], free: list[int], min_cut: int) -> int | None:
    """Fill gaps from the emptiest bins; returns the bin left partly filled, if any."""
    order = sorted(range(len(bins)), key=lambda b: (free[b], b))
    lo, hi = 0, len(order) - 1
    while lo < hi:
        to, of = order[lo], order[hi]
        if free[to] < min_cut:
            lo += 1
        elif not bins[of]:
            hi -= 1
        else:
            doc, start, n = bins[of].pop()
            take = min(n, free[to])
            bins[to].append((doc, start, take))
            free[to] -= take
            free[of] += take
            if take < n:
                bins[of].append((doc, start + take, n - take))
    return order[hi] if order and bins[order[hi]] and free[order[hi]] else None


def _powers(pieces: list[Piece]) -> list[list[Piece]]:
    """Cut ``pieces`` into sequences whose lengths are powers of two."""
    total, out, queue = sum(p[2] for p in pieces), [], list(reversed(pieces))
    for bit in range(total.bit_length() - 1, -1, -1):
        if not total >> bit & 1:
            continue
        room, seq = 1 << bit, []
        while room:
            doc, start, n = queue.pop()
            take = min(n, room)
            seq.append((doc, start, take))
            room -= take
            if take < n:
                queue.append((doc, start + take, n - take))
        out.append(seq)
    return out


def pack_group(lengths: Sequence[int], size: int = SEQUENCE, min_cut: int = MIN_CUT) -> list[list[Piece]]:
    """Sequences of pieces ``(document, start, length)`` for documents of these lengths."""
    out: list[list[Piece]] = []
    rests: list[Piece] = []
    for doc, n in enumerate(lengths):
        whole = n - n % size
        out += [[(doc, at, size)] for at in range(0, whole, size)]
        if n % size:
            rests.append((doc, whole, n % size))
    rests.sort(key=lambda p: -p[2])
    tree = CapacityTree(len(rests), size)
    bins: list[list[Piece]] = []
    for p in rests:
        b = tree.place(p[2])
        if b == len(bins):
            bins.append([])
        bins[b].append(p)
    free = [size - sum(p[2] for p in b) for b in bins]
    last = _top_up(bins, free, min_cut)
    for b, pieces in enumerate(bins):
        if pieces:
            out += _powers(pieces) if b == last else [pieces]
    return out


def tokenized(docs: DataFrame, path: str, kind: str, end_id: int, groups: int, seed: int) -> DataFrame:
    """``(doc_id, grp, ids)``: ids as little-endian uint32 bytes with the end id."""
    end = int(end_id).to_bytes(4, "little")

    def encode(batches: Iterator) -> Iterator:
        import pandas as pd

        tok = load(path, kind)
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at : at + 256]
                ids = [x + end for x in tok.encode(part["text"].tolist())]
                yield pd.DataFrame({"doc_id": part["doc_id"], "grp": part["grp"], "ids": ids})

    ship_package(docs.sparkSession)
    text = text_or_empty()
    grp = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), text), F.lit(groups))
    return docs.select("doc_id", text.alias("text"), grp.alias("grp")).mapInPandas(
        encode, docs.select("doc_id", F.lit(0).cast("bigint").alias("grp"), F.lit(b"").alias("ids")).schema
    )


def pack(docs: DataFrame, size: int = SEQUENCE, tokenizer: str | None = None, kind: str = "word", end_id: int = END_ID,
         group_docs: int = GROUP_DOCS, min_cut: int = MIN_CUT, seed: int = 17) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``, one row per piece.

    ``ids`` are the piece's ids, little-endian uint32.  A null text counts as
    empty and gives the end id alone; repeated rows are packed once each.
    Columns other than doc_id and text are not read.  An empty table gives an
    empty result.
    """
    groups = max(1, -(-docs.count() // group_docs))
    path = tokenizer or tokenizer_path(TOKENIZER)
    ids = tokenized(docs, path, kind, end_id, groups, seed)

    def pack_one(pdf):
        import pandas as pd

        # Rows come in any order from the shuffle: sort, so that a rerun packs alike.
        pdf = pdf.assign(n=pdf["ids"].str.len() // 4).sort_values(["n", "doc_id", "ids"], ascending=[False, True, True], kind="stable")
        docs_, blobs, lengths, grp = pdf["doc_id"].tolist(), pdf["ids"].tolist(), pdf["n"].tolist(), int(pdf["grp"].iloc[0])
        rows = []
        for k, seq in enumerate(pack_group(lengths, size, min_cut)):
            offset = 0
            for doc, start, n in seq:
                rows.append((docs_[doc], start, n, lengths[doc], (grp << 32) + k, offset, blobs[doc][4 * start : 4 * (start + n)]))
                offset += n
        out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
        out["doc_id"] = pd.array(out["doc_id"], dtype="Int64") if pdf["doc_id"].isna().any() else out["doc_id"]
        return out

    kind_of = docs.schema["doc_id"].dataType.simpleString()
    return ids.groupBy("grp").applyInPandas(
        pack_one, f"doc_id {kind_of}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    )


def packed(docs: DataFrame) -> DataFrame:
    """Pieces with a digest instead of the ids: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``."""
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
