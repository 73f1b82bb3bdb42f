"""Packing of whole documents: operators of the genetic algorithm, and every id once in few sequences."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import genetic_packing as G
from quire.llm.tokenization import tokenizer_path

from ..conftest import SF001
from . import edge


def valid(packing, sizes, size):
    items = sorted(i for b in packing.bins for i in b)
    assert items == list(range(len(sizes)))
    assert packing.fills == [sum(sizes[i] for i in b) for b in packing.bins]
    assert all(0 < f <= size for f in packing.fills)


def drawn(rng, n, size):
    return sorted((rng.choice([rng.randint(1, size), rng.randint(1, size // 4), size // 3, 1]) for _ in range(n)), reverse=True)


@pytest.mark.parametrize("seed", range(8))
def test_children_are_packings(seed):
    rng = random.Random(seed)
    sizes = drawn(rng, rng.randint(1, 60), 100)
    packs = [G.best_fit([], [], rng.sample(range(len(sizes)), len(sizes)), sizes, 100) for _ in range(4)]
    for _ in range(30):
        one, two = rng.choice(packs), rng.choice(packs)
        before = [list(b) for b in one.bins], [list(b) for b in two.bins]
        child = G.crossover(rng, one, two, sizes, 100)
        valid(child, sizes, 100)
        valid(G.mutate(rng, child, sizes, 100), sizes, 100)
        assert before == ([list(b) for b in one.bins], [list(b) for b in two.bins])
        assert G.Packing.of(child.numbers(len(sizes)), sizes).worth() == child.worth()
        packs[rng.randrange(4)] = child


def test_crossover_keeps_whole_bins_of_the_other_parent():
    rng = random.Random(4)
    sizes = drawn(rng, 40, 100)
    one, two = (G.best_fit([], [], rng.sample(range(40), 40), sizes, 100) for _ in range(2))
    child = G.crossover(rng, one, two, sizes, 100)
    own = {frozenset(b) for b in two.bins}
    assert sum(any(o <= set(b) for o in own) for b in child.bins) >= len(two.bins) // 4


def fewest(sizes, size):
    """Exact minimum by trying all."""
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for r in {room for room in rooms if room >= sizes[i]}:
            k = rooms.index(r)
            place(i + 1, [*rooms[:k], r - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, size - sizes[i]])

    place(0, [])
    return best[0]


def test_evolution_finds_the_fewest_bins():
    rng = random.Random(9)
    better = 0
    for _ in range(40):
        sizes = sorted((rng.randint(12, 55) for _ in range(12)), reverse=True)
        start = len(G.best_fit([], [], range(12), sizes, 100).bins)
        found = G.evolve(rng, sizes, [], 100, generations=60)
        valid(found[0], sizes, 100)
        assert G.least_bins(sizes, 100) <= len(found[0].bins) == fewest(sizes, 100)
        better += len(found[0].bins) < start
    assert better > 0


def check_pieces(rows, docs, size, end_id, tok):
    """Rows of ``pack_whole`` against ids of whole texts; returns the number of sequences."""
    want = collections.Counter()
    for doc, text in docs:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, end_id]
        for k, at in enumerate(range(0, len(ids), size)):
            want[doc, k, at, np.array(ids[at : at + size], "<u4").tobytes()] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], bytes(r["ids"])) for r in rows) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) // 4
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


@pytest.mark.parametrize("size,group_items", [(4096, 1024), (256, 40), (64, 16)])
def test_pieces_of_the_supplied_texts(spark, size, group_items):
    df = spark.read.parquet(f"{SF001}/documents.parquet").repartition(4)
    tok = Tokenizer.from_file(tokenizer_path(G.TOKENIZER))
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    rows = G.pack_whole(df, size=size, group_items=group_items).collect()
    sequences = check_pieces(rows, docs, size, 1, tok)
    assert sequences <= 1.02 * G.least_bins([r["length"] for r in rows], size) + 1


def test_query_rows(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = G.pack_whole(df).collect()
    got = G.packed_whole(df).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"])
    assert sorted((*key(r), r["ids_crc32"]) for r in got) == sorted((*key(r), zlib.crc32(bytes(r["ids"]))) for r in rows)


def test_edge_rows(spark):
    tok = Tokenizer.from_file(tokenizer_path(G.TOKENIZER))
    docs = [(r[0], r[1]) for r in edge.ROWS]
    for size in (4096, 8):
        check_pieces(G.pack_whole(edge.table(spark), size=size, group_items=4).collect(), docs, size, 1, tok)
    assert G.pack_whole(edge.empty(spark)).count() == 0
    copies = [(2**61, "the same few words again", "en", "a")] * 3000
    rows = G.pack_whole(edge.table(spark, copies).repartition(3)).collect()
    assert check_pieces(rows, [(r[0], r[1]) for r in copies], 4096, 1, tok) == -(-3000 * 6 // 4096)


def test_islands_hand_on_their_best(spark):
    rng = random.Random(2)
    problems = spark.createDataFrame([(g, sorted((rng.randint(15, 60) for _ in range(60)), reverse=True)) for g in range(5)], "grp bigint, sizes array<int>")
    found = {r["grp"]: r["best"] for r in G.evolve_groups(problems, 100, epochs=3).collect()}
    again = {r["grp"]: r["best"] for r in G.evolve_groups(problems.orderBy(F.desc("grp")), 100, epochs=3).collect()}
    assert found == again and len(found) == 5
    for r in problems.collect():
        valid(G.Packing.of(found[r["grp"]], r["sizes"]), r["sizes"], 100)
        assert len(set(found[r["grp"]])) <= len(G.best_fit([], [], range(60), r["sizes"], 100).bins)
