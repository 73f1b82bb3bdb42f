"""I-Match fingerprints: edited texts against brute force, and what fingerprints must keep."""

import hashlib
import re
import struct

import pytest
import xxhash

from quire.llm import imatch as I

from ..conftest import SF001
from . import edge


def edited(rows):
    """(doc_id, n_chars, sha256 of the edited text) in descending order of doc_id, text."""
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()), reverse=True)
    out = []
    for k, (doc, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        n = len(text) // 3
        out.append((doc, len(text), hashlib.sha256((text[: len(text) - n] + after[:n]).encode()).hexdigest()))
    return sorted(out, key=str)


def h64(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed=seed)


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def brute(rows):
    """(doc_id, fingerprint, edited fingerprint, near_edited, near_next) in descending order of doc_id, from plain sets."""
    texts = [t for _, t in rows]
    edited = []
    for k, t in enumerate(texts):
        n = len(t) // 3
        edited.append(t[: len(t) - n] + texts[(k + 1) % len(texts)][:n])

    def words(t):
        return {w for w in re.split(r"[\W_]+", t.lower()) if w}

    df = {}
    for t in texts:
        for w in words(t):
            df[w] = df.get(w, 0) + 1
    low, high = max(2, -(-len(texts) * I.MIN_SHARE // 1)), max(2, len(texts) * I.MAX_SHARE)
    lexicon = {}
    for w, n in df.items():
        if low <= n <= high:
            term = signed(h64(w.encode()))
            drawn = [h64(struct.pack("<q", term), h64(struct.pack("<i", k))) for k in range(I.SUBSETS)]
            lexicon[w] = (term, {k for k in range(I.SUBSETS) if signed(drawn[k]) % (1 << 20) < int(I.RATES[k // I.PER_RATE] * (1 << 20))})

    def fingerprint(t):
        out = []
        for k in range(I.SUBSETS):
            h = 42
            terms = sorted(lexicon[w][0] for w in words(t) if w in lexicon and k in lexicon[w][1])
            for term in terms:
                h = h64(struct.pack("<q", term), h)
            out.append(h if terms else 0)
        return out if any(out) else [h64(t.lower().encode())] + [0] * (I.SUBSETS - 1)

    def near(a, b):
        return 1.0 if a == b else sum(x == y != 0 for x, y in zip(a, b)) / sum(x != 0 or y != 0 for x, y in zip(a, b))

    def told(f):
        return "".join(f"{h:016x}" for h in f)

    fp, fp2 = [fingerprint(t) for t in texts], [fingerprint(t) for t in edited]
    return [(d, told(fp[k]), told(fp2[k]), near(fp[k], fp2[k]), near(fp[k], fp[(k + 1) % len(fp)])) for k, (d, _) in enumerate(rows)]


def test_fingerprints_by_brute_force(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), reverse=True)
    assert len({d for d, _ in rows}) == len(rows)
    got = I.fingerprints(df, 60).select("doc_id", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()
    assert [tuple(r) for r in sorted(got, reverse=True)] == brute(rows)


@pytest.mark.parametrize("block_docs", [7, 60, 1000])
def test_edited_texts(spark, block_docs):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    out = I.fingerprints(df, block_docs).collect()
    assert sorted((tuple(r)[:3] for r in out), key=str) == edited(rows)
    texts, by_text = dict(rows), {}
    for r in out:
        assert by_text.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert sum(r["near_edited"] > r["near_next"] for r in out) > 0.6 * len(out)


def test_neighbours_with_equal_texts_are_alike(spark):
    df = spark.createDataFrame([(k, "same words in all of these documents here") for k in range(5)], "doc_id long, text string")
    assert {r["near_next"] for r in I.fingerprints(df, 2).collect()} == {1.0}


def test_edge_rows(spark):
    out = I.fingerprints(edge.table(spark), 3).collect()
    assert sorted((tuple(r)[:3] for r in out), key=str) == edited([(r[0], r[1]) for r in edge.ROWS])
    assert I.fingerprints(edge.empty(spark)).count() == 0


def test_one_document_is_its_own_neighbour(spark):
    out = I.fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert out["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and out["near_next"] == 1.0
