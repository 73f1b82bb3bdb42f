"""Alignment: tokens of whole texts, merged one by one, against the lockstep and the query's columns."""

import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quire.llm import alignment as L
from quire.llm import tokenization as T
from quire.llm.tokenization import tokenizer_path

from ..conftest import SF001
from . import edge
from .test_tokens import ODD

STRANGE = ["▁", "a▁b", "a ▁", "<s> </s> <unk>", "<0x41> <0x0A>", "a <|endoftext|> b", "<|endoftext|>", "日本語のテキスト と 한국어 हिन्दी 😀", "tab\tx", "x\n", "\nx", " x ", "a\r\nb"]


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(tokenizer_path(L.TOKENIZER_A))
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(L.TOKENIZER_B))


def tokens(plain, text):
    """``(ids of A, their bytes, ids of B, their bytes)`` of one text, or None."""
    if not text:
        return None
    tok, sp = plain
    back = {c: b for b, c in enumerate(T.byte_tokens())}
    a = tok.encode(" " + text, add_special_tokens=False).ids
    b = sp.encode(text)
    bytes_a = [bytes(back[c] for c in tok.id_to_token(k)) for k in a]
    bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(k) else p.replace("▁", " ").encode() for k, p in zip(b, map(sp.id_to_piece, b))]
    whole = (" " + text).encode()
    return (a, bytes_a, b, bytes_b) if b"".join(bytes_a) == whole == b"".join(bytes_b) else None


def merged(plain, text):
    """``(n_a, n_b, groups, links)`` by one pointer on each side."""
    found = tokens(plain, text)
    if found is None:
        return 0, 0, [], []
    a, bytes_a, b, bytes_b = found
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    cuts = sorted(set(ends_a) & set(ends_b))
    groups, links, i, j = [], [], 0, 0
    for cut in cuts:
        x, y = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
        groups.append((a[i:x], b[j:y]))
        links.append((a[x - 1], b[y - 1]))
        i, j = x, y
    return len(a), len(b), groups, links


def shown(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def texts(n=300):
    rng = random.Random(8)
    return [*ODD, *STRANGE, *("".join(rng.choice(["the ", "a", "b", "é", "\n", " ", "ing", ".", "'s", "日", "1", "\t", "▁", "zx"]) for _ in range(rng.randint(1, 40))) for _ in range(n))]


def test_pieces_of_chunks_are_those_of_whole_texts(plain):
    both = T.PieceTokenizer(tokenizer_path(L.TOKENIZER_B)), T.ChunkTokenizer(tokenizer_path(L.TOKENIZER_A), "byte", plain=True)
    for text, b, a in zip(texts(), both[0].encode(texts()), both[1].encode(texts()), strict=True):
        assert np.frombuffer(b, "<u4").tolist() == plain[1].encode(text), repr(text)
        assert np.frombuffer(a, "<u4").tolist() == plain[0].encode(text, add_special_tokens=False).ids, repr(text)


def test_generations_of_the_cache(plain, monkeypatch):
    monkeypatch.setattr(T, "CACHE_CHUNKS", 40)
    tok = T.ChunkTokenizer(tokenizer_path(L.TOKENIZER_A), "byte", plain=True)
    for at in range(0, 300, 20):
        part = texts()[at : at + 20]
        for text, ids in zip(part, tok.encode(part), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == plain[0].encode(text, add_special_tokens=False).ids
        assert len(tok._cache) + len(tok._older) < 1000


@pytest.mark.parametrize("lane_bytes", [L.LANE_BYTES, 3, 20])
def test_lockstep_against_one_by_one(plain, lane_bytes, monkeypatch):
    monkeypatch.setattr(L.lanes, "__defaults__", (lane_bytes,))
    both = L.aligner(tokenizer_path(L.TOKENIZER_A), tokenizer_path(L.TOKENIZER_B))
    size = len(both.bytes_b)
    for part in (texts(), [], [""], [edge.LONG[:5000]], ["▁", "", "a▁"]):
        for text, (a, b, groups, links) in zip(part, both.align(part), strict=True):
            n_a, n_b, want, pairs = merged(plain, text)
            assert (len(a), len(b), groups) == (n_a, n_b, shown(want)), repr(text)
            assert [divmod(k, size) for k in links.tolist()] == pairs


def expected(plain, rows):
    found = [(doc, merged(plain, text)) for doc, text in rows]
    counts = collections.Counter(pair for _, m in found for pair in m[3])
    most = collections.defaultdict(int)
    for (a, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (doc, n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(shown(groups).encode()).hexdigest() if n_a else "")
        for doc, (n_a, n_b, groups, links) in found
    ]


@pytest.mark.parametrize("source", ["supplied", "edge", "strange"])
def test_query_rows(spark, plain, source):
    if source == "supplied":
        df = spark.read.parquet(f"{SF001}/documents.parquet").repartition(3)
    elif source == "edge":
        df = edge.table(spark)
    else:
        df = edge.table(spark, [(2**60 + k % 50, t, "en", "a") for k, t in enumerate(texts(100))])
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = L.alignment_digests(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected(plain, rows), key=str)


def test_empty_table_and_the_bound_of_pairs(spark, plain):
    assert L.alignment_digests(edge.empty(spark)).count() == 0
    both = L.aligner(tokenizer_path(L.TOKENIZER_A), tokenizer_path(L.TOKENIZER_B))
    assert L.most_pairs(both.bytes_a, both.bytes_b) < 300_000
    assert L.most_pairs([b"ab", b"b", b""], [b"b", b"cab"]) == 4  # ab-b, b-b, ab-cab, b-cab


def test_chunks_are_aligned_once_and_kept_in_bounds(plain, monkeypatch):
    monkeypatch.setattr(L, "ALIGNED_CHUNKS", 40)
    both = L.Aligner(tokenizer_path(L.TOKENIZER_A), tokenizer_path(L.TOKENIZER_B))
    size, seen = len(both.bytes_b), []
    monkeypatch.setattr(both, "_aligned", lambda told, *ids, of=both._aligned: seen.extend(told) or of(told, *ids))
    for at in range(0, 300, 20):
        part = texts()[at : at + 20]
        n_a, n_b, groups, links, ends = both.rows(part)
        links = np.split(links, ends[:-1])
        for text, *got in zip(part, n_a, n_b, groups.to_pylist(), links, strict=True):
            a, b, want, pairs = merged(plain, text)
            assert got[:3] == [a, b, shown(want)], repr(text)
            assert [divmod(k, size) for k in got[3].tolist()] == pairs
        assert len(both._cache) + len(both._older) < 1000
    seen.clear()
    both.rows(["once more twice more thrice more"] * 50)
    assert sorted(seen) == sorted(set(seen)) and len(seen) <= 6
    assert both.rows([])[0].tolist() == [] and both.rows(["", ""])[2].to_pylist() == ["", ""]
