"""Periodic runs against brute force over all periods, and the query's columns against a plain rewriting."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from quire.llm import runs as R

from ..conftest import SF001
from . import edge


def all_runs(words):
    """Every maximal stretch of some smallest period, by trying all periods."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_batches_against_all_periods(seed):
    rng = random.Random(seed)
    for _ in range(150):
        docs = []
        for _ in range(rng.randint(1, 5)):
            words = [rng.choice("ab"[: rng.randint(1, 2)]) + rng.choice(["", "", "c"]) for _ in range(rng.randint(0, 40))]
            root, at = [rng.choice("abc") for _ in range(rng.randint(1, 9))], rng.randint(0, len(words))
            words[at:at] = (root * rng.randint(2, 9))[: rng.randint(1, 60)]
            docs.append([w.encode() for w in words])
        assert R.batch_runs(docs) == [all_runs(d) for d in docs]


def test_long_and_nested_runs():
    fib = [b"a"]
    prev = [b"b"]
    while len(fib) < 1500:
        fib, prev = fib + prev, fib
    for words in ([b"x"] * 3000, fib, ([b"a", b"b"] * 4 + [b"c"]) * 7, [b"x"] * 5, [b"x"] * 6, [b"a", b"b"] * 4, [b"a", b"b"] * 3 + [b"a"]):
        assert R.batch_runs([words, words]) == [all_runs(words)] * 2
    with pytest.raises(ValueError):
        R.sequence_runs(np.zeros(9, np.int64), least_exponent=3)


def test_wavelet_tree_against_sorting():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 64, 200):
        values = rng.permutation(n)
        tree = R.WaveletTree(values)
        lo = rng.integers(0, n, 50)
        hi = np.array([rng.integers(a + 1, n + 1) for a in lo])
        bound = rng.integers(0, n, 50)
        assert tree.below(lo, hi, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(lo, hi, bound)]
        k = np.array([rng.integers(0, b - a) for a, b in zip(lo, hi)])
        assert tree.smallest(lo, hi, k).tolist() == [int(np.sort(values[a:b])[x]) for a, b, x in zip(lo, hi, k)]


def expected(doc, text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]
    n, h = len(w), None if doc is None else zlib.crc32(str(doc).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = all_runs(w)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(x for i, x in enumerate(w) if i not in drop))]
    return (doc, len(runs), *((None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])), *sha)


def test_query_rows(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect() if len(r["text"] or "") < 6000]
    got = {r["doc_id"]: tuple(r) for r in R.run_digests(R.planted(df)).collect()}
    assert len(got) == df.count()
    for doc, text in rows:
        assert got[doc] == expected(doc, text)
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_edge_rows(spark):
    planted = [k for k in range(4000) if zlib.crc32(str(k).encode()) % 10 == 0][:60]
    words = [f"w{k % 11}" for k in range(97)]
    rows = [r for r in edge.ROWS if r[1] != edge.LONG] + [(k, " ".join(words[: k % 97 + 1]), "en", "a") for k in planted]
    rows += [(12, "a  a\ta\na\x0ba\x0ca\ra b", "en", "a"), (-(2**62) - 1, "no no no no no no", "en", "a"), (planted[0], None, "en", "a"), (planted[1], " ", "en", "a")]
    got = R.run_digests(R.planted(edge.table(spark, rows)).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(r[0], r[1]) for r in rows), key=str)
    assert R.run_digests(R.planted(edge.empty(spark))).count() == 0
    long = R.find_runs(edge.table(spark).where("doc_id = 6")).first()
    assert [tuple(r) for r in long["runs"]] == [(0, 36000, 12)] and long["collapsed"].split() == edge.LONG.split()[:12]


def test_small_batches_give_the_same(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    whole = R.find_runs(df).collect()
    assert sorted(R.find_runs(df, batch_words=1).collect()) == sorted(whole)
