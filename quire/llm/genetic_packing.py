"""Packing whole documents into few sequences by a grouping genetic algorithm on islands.

A document longer than a sequence gives full pieces, each a sequence, and a
rest; rests are never cut.  Packing them is bin packing:

* *Groups.*  Rests are dealt by hash into groups of about ``GROUP_ITEMS``.  Only
  their sizes take part; ids stay in the written pieces table.
* *Islands.*  ``ISLANDS`` tasks evolve a population each for every group.  A
  chromosome is a packing, its genes are bins.  Crossover injects some of the
  better filled bins of one parent into the other, removes the bins that hold
  the same documents, and puts those displaced back by best fit, largest first.
  Mutation takes the emptiest bin and a few others apart.
* *Migration.*  After each epoch the best packing of an island goes to the next
  one (an equi-join on group and island), and replaces its worst.  A group is
  done when an island meets the bound ceil(total / size), which no packing can
  beat, or after ``EPOCHS``.
* *Levels.*  The emptiest sequence of every group is opened again and its
  documents make the items of the next level, until one group is left; so the
  loss of one part-filled sequence a group does not add up.

Every epoch and level is a written table, so a lost executor costs the groups
of its running tasks.  A group has a bounded expected size on any input.
"""

from __future__ import annotations

import random
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.util import ship_package
from .common import stored, text_or_empty
from .tokenization import load, tokenizer_path

SEQUENCE = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
GROUP_ITEMS = 1024
ISLANDS = 3
POPULATION = 6
GENERATIONS = 10
EPOCHS = 3

Bins = list[list[int]]


class Packing:
    """Bins of items and how full they are."""

    __slots__ = ("bins", "fills")

    def __init__(self, bins: Bins, fills: list[int]):
        self.bins, self.fills = bins, fills

    def worth(self) -> tuple[int, int]:
        """Fewer bins first; then the more unevenly filled."""
        return len(self.bins), -sum(f * f for f in self.fills)

    def numbers(self, n: int) -> list[int]:
        out = [0] * n
        for b, items in enumerate(self.bins):
            for i in items:
                out[i] = b
        return out

    @classmethod
    def of(cls, numbers: Sequence[int], sizes: Sequence[int]) -> Packing:
        bins: Bins = [[] for _ in range(max(numbers, default=-1) + 1)]
        for i, b in enumerate(numbers):
            bins[b].append(i)
        return cls(bins, [sum(sizes[i] for i in items) for items in bins])


def best_fit(bins: Bins, fills: list[int], items: Sequence[int], sizes: Sequence[int], size: int) -> Packing:
    """Put each of ``items`` in turn into the fullest bin with room for it, a new one if there is none."""
    rooms = sorted((size - f, b) for b, f in enumerate(fills))
    for i in items:
        at = bisect_left(rooms, (sizes[i], -1))
        if at == len(rooms):
            room, b = size, len(bins)
            bins.append([])
            fills.append(0)
        else:
            room, b = rooms.pop(at)
        bins[b].append(i)
        fills[b] += sizes[i]
        insort(rooms, (room - sizes[i], b))
    return Packing(bins, fills)


def crossover(rng: random.Random, one: Packing, two: Packing, sizes: Sequence[int], size: int) -> Packing:
    """A child of ``one`` with some whole well-filled bins of ``two``."""
    full = sorted(range(len(two.bins)), key=lambda b: -two.fills[b])[: max(1, (len(two.bins) + 1) // 2)]
    given = rng.sample(full, max(1, len(full) // 2))
    inside = {i for b in given for i in two.bins[b]}
    bins, fills, displaced = [list(two.bins[b]) for b in given], [two.fills[b] for b in given], []
    for items, fill in zip(one.bins, one.fills, strict=True):
        if inside.isdisjoint(items):
            bins.append(list(items))
            fills.append(fill)
        else:
            displaced += [i for i in items if i not in inside]
    return best_fit(bins, fills, sorted(displaced), sizes, size)


def mutate(rng: random.Random, one: Packing, sizes: Sequence[int], size: int) -> Packing:
    """``one`` with its emptiest bin and up to three others packed anew."""
    order = sorted(range(len(one.bins)), key=lambda b: one.fills[b])
    opened = {order[0], *rng.sample(order, min(3, len(order)))}
    bins = [list(items) for b, items in enumerate(one.bins) if b not in opened]
    fills = [f for b, f in enumerate(one.fills) if b not in opened]
    loose = sorted(i for b in opened for i in one.bins[b])
    if rng.random() < 0.5:
        rng.shuffle(loose)
    return best_fit(bins, fills, loose, sizes, size)


def least_bins(sizes: Sequence[int], size: int) -> int:
    """No packing has fewer bins: by volume, and by items of more than half a bin."""
    return max(-(-sum(sizes) // size), sum(2 * s > size for s in sizes))


def evolve(rng: random.Random, sizes: Sequence[int], population: list[Packing], size: int, wanted: int = POPULATION, generations: int = GENERATIONS) -> list[Packing]:
    """A population of packings of ``sizes`` (largest first), best first; new where there are fewer than ``wanted``."""
    bound, n = least_bins(sizes, size), len(sizes)
    population = sorted(population, key=Packing.worth)[:wanted]
    while len(population) < wanted and not (population and len(population[0].bins) <= bound):
        order = list(range(n))
        if population:  # near to decreasing order: neighbours change places
            order.sort(key=lambda i: sizes[i] * rng.uniform(0.7, 1.0), reverse=True)
        population.append(best_fit([], [], order, sizes, size))
        population.sort(key=Packing.worth)
    for _ in range(generations):
        if len(population[0].bins) <= bound:
            break
        one, two = rng.sample(population[: max(2, wanted // 2)], 2) if len(population) > 1 else (population[0], population[0])
        child = crossover(rng, one, two, sizes, size)
        child = min(child, mutate(rng, child, sizes, size), key=Packing.worth)
        if all(child.worth() != p.worth() for p in population):  # copies would take the population over
            population.append(child)
            population.sort(key=Packing.worth)
            del population[wanted:]
    return population


_STATE = "grp bigint, island int, sizes array<int>, population array<array<int>>, bins int, worth bigint, done boolean"


def _epoch(state: DataFrame, epoch: int, size: int, seed: int) -> DataFrame:
    """One epoch on every island: ``state`` with evolved populations, best packing first."""

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            out = []
            for grp, island, sizes, population in zip(pdf["grp"], pdf["island"], pdf["sizes"], pdf["population"], strict=True):
                sizes = sizes.tolist()
                rng = random.Random(f"{seed}/{epoch}/{grp}/{island}")
                found = evolve(rng, sizes, [Packing.of(p.tolist(), sizes) for p in population], size)
                worth = found[0].worth()
                out.append((grp, island, sizes, [p.numbers(len(sizes)) for p in found], worth[0], worth[1], worth[0] <= least_bins(sizes, size)))
            yield pd.DataFrame(out, columns=["grp", "island", "sizes", "population", "bins", "worth", "done"])

    return state.select("grp", "island", "sizes", "population").mapInPandas(run, _STATE)


def evolve_groups(problems: DataFrame, size: int = SEQUENCE, islands: int = ISLANDS, epochs: int = EPOCHS, seed: int = 23) -> DataFrame:
    """``(grp, best)`` for ``problems`` ``(grp, sizes)``: the bin of each item of the best packing found."""
    none = F.array().cast("array<array<int>>")
    state = problems.select("grp", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "sizes", none.alias("population"))
    chosen = F.min_by(F.col("population")[0], F.struct("bins", "worth", "island")).alias("best")
    ended = []
    for epoch in range(epochs):
        state = stored(_epoch(state, epoch, size, seed), "islands")
        groups = state.groupBy("grp").agg(F.bool_or("done").alias("done"), chosen)
        last = epoch + 1 == epochs
        ended.append(groups.where(F.lit(last) | F.col("done")).select("grp", "best"))
        if last or not (going := stored(groups.where(~F.col("done")).select("grp"), "islands-going")).take(1):
            break
        # The best of each island moves on by one, in place of the worst there.
        guests = state.select("grp", ((F.col("island") + 1) % islands).cast("int").alias("island"), F.slice("population", 1, 1).alias("guest"))
        stay = F.slice("population", 1, F.greatest(F.lit(1), F.size("population") - 1))
        state = (
            state.join(going, "grp", "left_semi").join(guests, ["grp", "island"])
            .select("grp", "island", "sizes", F.concat("guest", stay).alias("population"))
        )
    out = ended[0]
    for more in ended[1:]:
        out = out.unionByName(more)
    return out


def _placed(problems: DataFrame, best: DataFrame, size: int, open_emptiest: bool) -> DataFrame:
    """``(pid, size, grp, bin, offset, again)``: places of the items; ``again`` for those of a group's emptiest bin, when it has room."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        for pdf in batches:
            for grp, pids, sizes, bins in zip(pdf["grp"], pdf["pids"], pdf["sizes"], pdf["best"], strict=True):
                order = np.argsort(bins, kind="stable")
                s, b = sizes[order].astype(np.int64), bins[order]
                ends = np.cumsum(s)
                first = np.searchsorted(b, b)
                fills = np.bincount(b, weights=s)
                weak = int(np.argmin(fills)) if open_emptiest and fills.min() < size else -1
                yield pd.DataFrame({"pid": pids[order], "size": s, "grp": grp, "bin": b, "offset": ends - s - (ends - s)[first], "again": b == weak})

    both = problems.join(best, "grp")
    return both.mapInPandas(run, "pid bigint, size bigint, grp bigint, bin int, offset bigint, again boolean")


def pack_items(items: DataFrame, size: int = SEQUENCE, group_items: int = GROUP_ITEMS, islands: int = ISLANDS, epochs: int = EPOCHS, seed: int = 23) -> DataFrame:
    """``(pid, sequence_id, offset)`` for ``items`` ``(pid, size)``, pid unique, 0 < size <= the sequence's."""
    ship_package(items.sparkSession)
    out, level, n = [], 0, items.count()
    while True:
        groups = max(1, -(-n // group_items))
        grp = F.pmod(F.xxhash64(F.lit(seed + level), F.col("pid")), F.lit(groups))
        listed = F.sort_array(F.collect_list(F.struct(F.col("size").cast("int").alias("size"), "pid")), asc=False)
        problems = stored(
            items.groupBy(grp.alias("grp")).agg(listed.alias("l")).select("grp", F.col("l.pid").alias("pids"), F.col("l.size").alias("sizes")), "pack-groups"
        )
        best = evolve_groups(problems.select("grp", "sizes"), size, islands, epochs, seed + level)
        placed = stored(_placed(problems, best, size, open_emptiest=groups > 1), "pack-places")
        # Level, group and bin in one number: at most 64 levels, 2^40 groups, 2^16 bins.
        number = (F.lit(level << 40).cast("bigint") + F.col("grp")) * F.lit(1 << 16) + F.col("bin")
        again = placed.where("again").select("pid", "size")
        left = again.count()
        # Groups of a few sequences each are opened no more: every level has half the items at most.
        last = groups == 1 or 2 * left > n
        out.append((placed if last else placed.where("not again")).select("pid", number.alias("sequence_id"), "offset"))
        if last:
            break
        items, level, n = again, level + 1, left
    plan = out[0]
    for more in out[1:]:
        plan = plan.unionByName(more)
    return plan


def pieces(docs: DataFrame, path: str, kind: str, end_id: int, size: int) -> DataFrame:
    """``(pid, doc_id, piece, start, length, ids)`` as a table; ids in two bytes each where the vocabulary allows."""
    narrow = load(path, kind).size() <= 1 << 16 and end_id < 1 << 16
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        tok = load(path, kind)
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part, rows = pdf.iloc[at : at + 256], []
                for doc, ids in zip(part["doc_id"], tok.encode(part["text"].tolist()), strict=True):
                    ids = np.frombuffer(ids + end, "<u4")
                    told = ids.astype("<u2") if narrow else ids
                    rows += [(doc, k, s, min(size, len(ids) - s), told[s : s + size].tobytes()) for k, s in enumerate(range(0, len(ids), size))]
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids"])

    ship_package(docs.sparkSession)
    kind_of = docs.schema["doc_id"].dataType.simpleString()
    # Ids of documents travel as text, which keeps nulls and large numbers exact.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"))
    out = rows.mapInPandas(cut, "doc_id string, piece int, start bigint, length bigint, ids binary")
    return stored(out.select(F.monotonically_increasing_id().alias("pid"), F.col("doc_id").cast(kind_of).alias("doc_id"), "piece", "start", "length", "ids"), "pack-pieces")


def _wide(ids):
    """Ids of two or four bytes (told by the length of the piece) as four bytes each."""
    @F.pandas_udf("binary")
    def widen(ids: pd.Series, length: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series([x if len(x) == 4 * n else np.frombuffer(x, "<u2").astype("<u4").tobytes() for x, n in zip(ids, length, strict=True)], dtype=object)

    return widen(ids, F.col("length"))


def pack_whole(docs: DataFrame, size: int = SEQUENCE, tokenizer: str | None = None, kind: str = "word", end_id: int = END_ID,
               group_items: int = GROUP_ITEMS, islands: int = ISLANDS, epochs: int = EPOCHS, seed: int = 23) -> DataFrame:
    """``(doc_id, piece, start, length, sequence_id, offset, ids)``, one row per piece; ids little-endian uint32.

    Documents of at most ``size`` ids stay whole, longer ones are cut every
    ``size`` ids.  A null text counts as empty and gives the end id alone;
    repeated rows are packed once each.  Columns other than doc_id and text are
    not read.  An empty table gives an empty result.
    """
    table = pieces(docs, tokenizer or tokenizer_path(TOKENIZER), kind, end_id, size)
    plan = pack_items(table.where(F.col("length") < size).select("pid", F.col("length").alias("size")), size, group_items, islands, epochs, seed)
    cols = ["doc_id", "piece", "start", "length", "sequence_id", "offset", "ids"]
    rests = table.where(F.col("length") < size).join(plan, "pid").select(*cols)
    full = table.where(F.col("length") == size).select("*", (-1 - F.col("pid")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")).select(*cols)
    return rests.unionByName(full).withColumn("ids", _wide(F.col("ids")))


def packed_whole(docs: DataFrame) -> DataFrame:
    """Pieces with a digest instead of the ids."""
    return pack_whole(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
