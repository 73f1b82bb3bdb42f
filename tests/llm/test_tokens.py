"""Tokenizing in chunks, the token store, and packing."""

import collections
import random
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quire.llm import packing as K
from quire.llm import token_store as T
from quire.llm import tokenization as Z
from quire.llm.tokenization import ChunkTokenizer, tokenizer_path

from ..conftest import SF001
from . import edge

FILES = {"byte": "byte_bpe_50k.json", "word": "word_bpe_49k.json"}
ODD = ["", "  a  b\n\n c", "\n", "a\n", " a", "a ", "x\t y", "É à <|endoftext|> z", " \n", "a  \n b", "don't it's 5\n6 7", "a.. b., c!? 'd. e's. ²., 一.", "x\x01y \x01 z", "Σας ΣΑΣ. İi.", "a\x00b c", "é. a ́c"]


@pytest.mark.parametrize("kind", FILES)
def test_chunks_give_the_ids_of_whole_texts(kind):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab .,\n!'s1é²\t\x01-") for _ in range(rng.randint(1, 40))) for _ in range(800)]
    path = tokenizer_path(FILES[kind])
    whole = Tokenizer.from_file(path)
    for text, ids in zip(texts, ChunkTokenizer(path, kind).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("kind", FILES)
def test_columns_give_the_ids_of_whole_texts(kind, monkeypatch):
    rng = random.Random(2)
    parts = ["word", "Wörter", "a", "é", "Σ", "_", ".", ",", "'s", "'", "\"", "1", "²", "—", "’", "<", "<|", "|", "日", "\u3000", "\u2028", "\xa0", "\x85", "\u0301", "\t", "\x00", "\x01", " ", " ", " ", "\n", "=\u0338"]
    texts = [None, "", *ODD, *("".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(1500)), None, ""]
    whole = Tokenizer.from_file(tokenizer_path(FILES[kind]))
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    for column, size, cached in ((pa.array(texts), 1 << 20, None), (pa.array(["x", *texts], pa.large_string()).slice(1), 100, 50)):
        monkeypatch.setattr(Z, "SLICE_BYTES", size)
        tok = ChunkTokenizer(tokenizer_path(FILES[kind]), kind, cached=cached)
        for text, ids, told in zip(texts, want, tok.encode_column(column), strict=True):
            assert np.frombuffer(told, "<u4").tolist() == ids, repr(text)
        assert not cached or len(tok._young.codes) + len(tok._old.codes) < 300
    assert list(tok.encode_column(pa.array([], pa.string()))) == []


def test_a_word_is_learnt_once_with_any_closing_marks(monkeypatch):
    tok, asked = ChunkTokenizer(tokenizer_path(FILES["byte"]), "byte"), []
    spell = tok._spell

    def noted(missing, known):
        asked.extend(missing)
        spell(missing, known)

    monkeypatch.setattr(tok, "_spell", noted)
    column = pa.array(["alpha beta, beta. beta! beta", "beta; alpha, beta\nbeta"])
    first, again = list(tok.encode_column(column)), list(tok.encode_column(column))
    assert first == again
    assert sorted(asked) == sorted(["alpha", " alpha", "beta", " beta", ",", ".", "!", ";", "\n"])


def expected_store(rows):
    tok = Tokenizer.from_file(tokenizer_path(FILES["byte"]))
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        out.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


@pytest.mark.parametrize("source", ["supplied", "edge"])
def test_store_round_trip(spark, source, monkeypatch):
    df = spark.read.parquet(f"{SF001}/documents.parquet") if source == "supplied" else edge.table(spark)
    path = tempfile.mkdtemp(prefix="quire-test-") + "/store"
    got = [tuple(r) for r in T.stored_tokens(df, path).collect()]
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert sorted(got, key=lambda r: r[1]) == expected_store(rows)


def test_one_document_by_range_reads(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    path = tempfile.mkdtemp(prefix="quire-test-") + "/store"
    manifest = T.write_store(df, path).collect()
    dictionary = T.read_dictionary(spark, path)
    assert dictionary
    want = {doc: crc for doc, _, _, crc in expected_store([(r["doc_id"], r["text"]) for r in df.collect()])}
    for doc in (0, 17, 199):
        shard = next(m for m in manifest if m["first_doc"] <= doc <= m["last_doc"])
        assert zlib.crc32(T.fetch(shard["shard"], dictionary, doc)) == want[doc]
        assert T.fetch(shard["shard"], dictionary, 10**9) is None


def test_shards_know_their_dictionary_and_damage():
    w = T.ShardWriter(b"")
    w.add(1, b"\x01\0\0\0")
    w.add(None, b"")
    data = w.finish()
    assert list(T.read_shard(data, b"")) == [(1, b"\x01\0\0\0"), (None, b"")]
    with pytest.raises(ValueError, match="dictionary"):
        list(T.read_shard(data, b"other"))
    with pytest.raises(ValueError, match="shard"):
        T.read_index(data[:-1] + b"x")


def test_empty_store(spark):
    path = tempfile.mkdtemp(prefix="quire-test-") + "/store"
    assert T.stored_tokens(edge.empty(spark), path).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_tree_places_first_fit(seed):
    rng = random.Random(seed)
    tree, room = K.CapacityTree(40, 50), [50] * 64
    for _ in range(150):
        size = rng.randint(1, 50)
        want = next((k for k, r in enumerate(room) if r >= size), -1)
        if want >= 0:
            room[want] -= size
        assert tree.place(size) == want


@pytest.mark.parametrize("seed", range(6))
def test_groups_are_packed_whole_with_little_padding(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 5, 60, 700, 3000, 4096, 4097, 9000]) + rng.randint(0, 30) for _ in range(rng.choice([1, 3, 200]))]
    seqs = K.pack_group(lengths)
    cover = collections.defaultdict(list)
    for seq in seqs:
        assert 0 < sum(p[2] for p in seq) <= K.SEQUENCE
        for doc, start, n in seq:
            cover[doc].append((start, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, part in sorted(cover[doc]):
            assert start == at and part > 0
            at += part
        assert at == n
    fills = [sum(p[2] for p in seq) for seq in seqs]
    padding = sum(K.SEQUENCE - f for f in fills if f & (f - 1))
    assert padding <= K.MIN_CUT * len(seqs)


def test_packed_pieces(spark):
    df = edge.table(spark)
    tok = Tokenizer.from_file(tokenizer_path(FILES["word"]))
    whole = collections.Counter()
    for r in df.select("doc_id", "text").collect():
        whole[r["doc_id"], np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()] += 1
    rows = K.pack(df, group_docs=4).collect()
    by_doc, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append((r["start"], bytes(r["ids"]), r["length"], r["doc_tokens"]))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc in {d for d, _ in whole}:
        want = sorted(ids for (d, ids), n in whole.items() for _ in range(n) if d == doc)
        assert sum(x[2] for x in by_doc[doc]) == sum(len(ids) for ids in want) // 4
        if len(want) == 1:
            assert b"".join(x[1] for x in sorted(by_doc[doc])) == want[0] and {x[3] for x in by_doc[doc]} == {len(want[0]) // 4}
    for pieces in seqs.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
    digests = K.packed(df)
    assert digests.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert K.packed(edge.empty(spark)).count() == 0
