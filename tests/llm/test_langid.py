"""Language ID: the forward sum against all segmentations, training, and held-out accuracy."""

import math
import zlib

import numpy as np
import pytest

from quire.llm import langid as L

from ..conftest import SF001
from . import edge

PIECES = ["▁", "▁a", "a", "ab", "b", "▁ab", "abc", "c", "bc"]


def all_ways(word, table, ids):
    if not word:
        return np.ones(table.shape[1])
    total = np.zeros(table.shape[1])
    for n in range(1, len(word) + 1):
        k = ids.get(word[:n], len(ids) if n == 1 else None)
        if k is not None:
            total += table[k] * all_ways(word[n:], table, ids)
    return total


def test_forward_sums_all_segmentations():
    ids = {p: k for k, p in enumerate(PIECES)}
    table = np.random.default_rng(0).random((len(PIECES) + 1, 3)) * 0.1
    words = ["▁a", "▁abc", "▁abcab", "▁zabx", "abcabc"]
    got = L.forward(words, ids, table)
    for w, row in zip(words, got, strict=True):
        assert np.allclose(row, np.log(all_ways(w, table, ids)))


def test_expected_counts_by_enumeration():
    ids = {p: k for k, p in enumerate(PIECES)}
    probs = np.append(np.full(len(PIECES), 0.1), L.UNKNOWN)

    def ways(word):
        if not word:
            return [[]]
        return [[word[:n], *rest] for n in range(1, len(word) + 1) if word[:n] in ids for rest in ways(word[n:])]

    want = np.zeros(len(PIECES))
    for word, n in (("▁abc", 2), ("▁ab", 1)):
        found = ways(word)
        weight = [math.prod(probs[ids[p]] for p in w) for w in found]
        for w, x in zip(found, weight, strict=True):
            for p in w:
                want[ids[p]] += n * x / sum(weight)
    assert np.allclose(L.expected_counts({"▁abc": 2, "▁ab": 1}, ids, probs), want)


def test_words_are_letters_with_their_marks():
    assert [len(w) for w in L.words_of("x" * 70 + " Ab-c1d")] == [71, 3, 2, 2]
    assert L.words_of("हिन्दी, e\u0301te\u0301 Ⅷ x²y \u0301") == ["▁हिन्दी", "▁e\u0301te\u0301", "▁x", "▁y"]


def test_all_lower_case_pieces_are_kept():
    from sentencepiece import SentencePieceProcessor

    path = L.tokenizer_path(L.VOCABULARY)
    sp, pieces = SentencePieceProcessor(model_file=path), set(L.pieces_of(path))
    for k in range(sp.get_piece_size()):
        p = sp.id_to_piece(k)
        if p.removeprefix("▁").isalpha():
            assert (p in pieces) == (p == p.lower())
    assert max(map(len, pieces)) > 12


def marginal(word, table, ids):
    """Sum over all segmentations with exact fractions, per language."""
    from fractions import Fraction

    out = []
    for column in table.T:
        a = [Fraction(1)] + [Fraction(0)] * len(word)
        for j in range(1, len(word) + 1):
            for i in range(j):
                k = ids.get(word[i:j], len(ids) if i + 1 == j else None)
                if k is not None:
                    a[j] += a[i] * Fraction(column[k])
        out.append(a[-1])
    return out


def exact_log(x):
    return (math.log(x.numerator) - math.log(x.denominator))


@pytest.mark.parametrize("n", [31, 32, 33, 34, 47, 48, 200])
def test_words_of_any_length_are_marginalised(n):
    ids = {p: k for k, p in enumerate(PIECES)}
    table = np.random.default_rng(n).random((len(PIECES) + 1, 2)) * 0.1
    table[-1] = L.UNKNOWN
    word = "▁" + "".join(np.random.default_rng(n + 1).choice(list("abcz"), n))
    want = [exact_log(x) for x in marginal(word, table, ids)]
    assert np.allclose(L.forward([word, "▁ab"], ids, table)[0], want)
    m = L.Model(PIECES, ["x", "y"], table, np.zeros(2))
    best = max(want)
    got = m.predict([word[1:] + " ab"])[0]
    logs = [w + exact_log(x) for w, x in zip(want, marginal("▁ab", table, ids))]
    assert got[0] == "xy"[logs.index(max(logs))] and best < 0
    assert math.isclose(got[1], 1 / sum(math.exp(x - max(logs)) for x in logs), rel_tol=1e-6)


def test_expected_counts_of_long_words(monkeypatch):
    """By logarithms as in batches, and a word of 5,000 letters without underflow."""
    ids = {p: k for k, p in enumerate(PIECES)}
    probs = np.append(np.full(len(PIECES), 0.1), L.UNKNOWN)
    counts = {"▁abcabz": 3, "▁ab": 1, "abcbcab": 2}
    want = L.expected_counts(counts, ids, probs)
    monkeypatch.setattr(L, "BATCHED", 0)
    assert np.allclose(L.expected_counts(counts, ids, probs), want)
    got = L.expected_counts({"▁" + "abc" * 2000: 1}, ids, probs)
    assert np.isfinite(got).all() and math.isclose((got * [len(p) for p in PIECES]).sum(), 6001, rel_tol=1e-9)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(L, "CACHE_WORDS", 3)
    table = np.random.default_rng(0).random((len(PIECES) + 1, 2)) * 0.1
    m = L.Model(PIECES, ["x", "y"], table, np.zeros(2))
    texts = ["a ab abc b c", "bc cb", "a ab", "abc b c bc ca aa bb"]
    one_by_one = [L.Model(PIECES, ["x", "y"], table, np.zeros(2)).predict([t])[0] for t in texts]
    assert [m.predict([t])[0] for t in texts] == one_by_one


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r["doc_id"]: r for r in L.identify(df).collect()}
    truth = {r["doc_id"]: r["lang"] for r in df.collect()}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2]
    assert sorted(d for d, r in rows.items() if r["held_out"]) == sorted(held)
    assert sum(rows[d]["lang_pred"] == truth[d] for d in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_labels_of_held_out_rows_are_not_used(spark):
    """Wrong labels on all held-out rows change nothing."""
    from pyspark.sql import functions as F

    df = spark.read.parquet(f"{SF001}/documents.parquet")
    spoiled = df.withColumn("lang", F.when(L.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(map(tuple, L.identify(df).collect())) == sorted(map(tuple, L.identify(spoiled).collect()))


def test_edge_rows(spark):
    out = L.identify(edge.table(spark)).collect()
    assert len(out) == len(edge.ROWS)
    by = {r["doc_id"]: r for r in out}
    assert [by[d]["lang_pred"] for d in (2, 4, 9)] == ["und"] * 3 and by[2]["score"] == 0.0
    assert not by[None]["held_out"]
    df = edge.table(spark)
    kept = L.keep_known(df)
    assert kept.columns == df.columns and not {2, 4, 9} & {r["doc_id"] for r in kept.collect()}
    assert L.identify(edge.empty(spark)).count() == 0 and L.keep_known(edge.empty(spark)).count() == 0


def test_null_ids_and_copies_leave_a_sample(spark):
    rows = [(None, f"the house number {k} is old", "en") for k in range(300)] + [(None, f"das haus nummer {k} ist alt", "de") for k in range(300)]
    rows += [(None, "the very same words", "en")] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(df, sample_docs=20)
    assert model.langs == ["de", "en"]
    assert [x[0] for x in model.predict(["the old house", "das alte haus", "12"])] == ["en", "de", "und"]


@pytest.mark.parametrize("lang", [None])
def test_without_labels_nothing_is_predicted(spark, lang):
    df = spark.createDataFrame([(1, "some words", lang)], "doc_id long, text string, lang string")
    assert L.identify(df).first()["lang_pred"] == "und"


def test_steps_find_the_pieces_of_all_cuts():
    """Many words walk the pieces at once; every cut as looking each one up gives it."""
    words, ids = ["▁abcab", "zabc▁a", "bcbcbc"], {p: k for k, p in enumerate(PIECES)}
    want = {}
    for j in range(1, 7):
        for i in range(j):
            got = [ids.get(w[i:j], len(ids) if i + 1 == j else -1) for w in words]
            if max(got) >= 0:
                want[i, j] = got
    got = L.Steps(ids).cuts(words)
    assert list(got) == list(want) and {k: v.tolist() for k, v in got.items()} == want
    assert {k: v.tolist() for k, v in L.Steps({}).cuts(["ab"]).items()} == {(0, 1): [0], (1, 2): [0]}


def test_texts_are_passed_on_in_arrow(spark, capsys):
    df = spark.createDataFrame([(k, "the old house", "en", "x" * 10) for k in range(8)], "doc_id long, TEXT string, lang string, source string")
    kept = L.keep_known(df)
    kept.explain()
    assert "MapInArrow" in capsys.readouterr().out
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, df.collect())) and kept.columns == df.columns
