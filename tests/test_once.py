"""Documents are analysed once, tasks hold pieces: counts kept as a table, prints of a few texts, files of a bucket."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators import codec as C
from quire.operators import containment
from quire.operators import index as I
from quire.plans import catalog
from quire.plans import pipeline as P
from quire.sinks.writers import write_index

from .conftest import SF001


@pytest.mark.parametrize("name", ["dictionary_index", "retrieve_lemmatized"])
def test_terms_are_counted_once(spark, monkeypatch, name):
    calls, real = [], I.term_counts
    monkeypatch.setattr(I, "term_counts", lambda *a, **k: (calls.append(1), real(*a, **k))[1])
    assert catalog.QUERIES[name](spark, SF001).limit(1).count() == 1
    assert len(calls) == 1


def test_prints_are_given_for_some_texts_at_a_time():
    texts = [None, ""] + [f"{k} the quick brown fox jumps over the lazy dog {k * 7}" for k in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["did", "dtext"])
    out = list(containment._prints(lambda text: [(4, 8)])(iter([batch])))
    assert max(len(set(b["id"].to_pylist())) for b in out) <= containment.ROWS_AT_ONCE < 500
    got = {(i, h) for b in out for i, h in zip(b["id"].to_pylist(), b["h"].to_pylist())}
    assert got == {(i, int(h)) for i, t in enumerate(texts) for h in containment.fingerprints(t or "", 4, 8).view(np.int64)}


def test_a_bucket_has_as_many_files_as_it_fills(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_index(P.index(spark, SF001), str(tmp_path), buckets=1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for d, _, fs in os.walk(tmp_path) if d.endswith("tb=0") for f in fs if f.endswith(".parquet")]
    assert len(files) > 1


def test_six_decimals_are_those_of_the_formatter(spark):
    values = [0.0, -0.0, 1.0, 0.1, 0.0000005, 0.0000015, 0.1234565, 0.1234575, 0.9999995, 1 / 3, 2 / 3, 1e-9, 123456.7890125, 1e13, -0.5, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "tf double")
    rows = df.select("tf", C.six_decimals("tf").alias("a"), F.format_string(C.TF_FORMAT, "tf").alias("b")).collect()
    assert [(r["tf"], r["a"]) for r in rows if r["a"] != r["b"]] == []
    assert "cast(tf" in C.six_decimals("tf")._jc.toString().lower()


def test_lists_without_line_breaks_are_decoded_alike(spark):
    lists = ["a:0.5, b:c:0.25, :1, x, y:, z:many, é:1e-05, ::2, d: 0.5", "a:0.5, b\nc:0.25, d:1\n", "", "p:1, q :2"]
    df = spark.createDataFrame([(str(k), t) for k, t in enumerate(lists)], "word string, documents string")
    item = F.explode(F.split("documents", C.ITEM_SEP)).alias("item")
    want = df.select("word", item).select("word", F.regexp_extract("item", C.POSTING, 1).alias("d"), F.when(F.col("item").rlike(C.POSTING), F.regexp_extract("item", C.POSTING, 2)).try_cast("double").alias("tf"))
    want = want.where("tf IS NOT NULL AND length(d) > 0")
    got = C.decode_postings(df).select("term", "doc_id", "tf")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_ranks_read_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(f"t{k % 9}", None if k == 7 else k, 1.0 / (1 + k % 5)) for k in range(400)]
    df = spark.createDataFrame(rows, "term string, doc_id long, tf double")
    ranked = I.ranked_postings(df.mapInArrow(look, df.schema), partitions=4)
    assert ranked.count() == 400 and seen.value == 400
    assert ranked.groupBy("term").agg(F.max("rank"), F.count_distinct("rank"), F.count("*")).where("NOT (`max(rank)` = `count(1)` AND `count(DISTINCT rank)` = `count(1)`)").count() == 0


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_df_comes_with_the_ranks(spark, partitions):
    rows = [("hot", d, 0.5 if d % 2 else 0.25) for d in range(200)] + [(f"t{d % 7}", d, 0.1) for d in range(30)] + [(None, 1, 0.1), (None, 2, 0.1), ("once", 5, 0.2)]
    df = spark.createDataFrame(rows, "term string, doc_id long, tf double")
    got = I.ranked_with_df(df, partitions=partitions).where("term IS NOT NULL")
    by_term = Window.partitionBy("term")
    rank = F.row_number().over(by_term.orderBy(F.col("tf").desc(), "doc_id"))
    want = df.where("term IS NOT NULL").select("term", rank.alias("rank"), "doc_id", "tf", F.count("*").over(by_term).alias("df"))
    assert sorted(map(tuple, got.select("term", "rank", "doc_id", "tf", "df").collect())) == sorted(map(tuple, want.collect()))


def test_a_term_over_many_batches_is_numbered_as_one():
    batches = [pa.RecordBatch.from_pydict({"term": t, "x": list(range(len(t)))}) for t in (["a", "b"], ["b", "b"], [], ["b", "c"], ["c"], ["d"])]
    out = pa.Table.from_batches(I._numbered(iter(batches))).to_pydict()
    assert out["term"] == ["a", "b", "b", "b", "b", "c", "c", "d"]
    assert out["rank"] == [1, 1, 2, 3, 4, 1, 2, 1] and out["n"] == [1, 4, 4, 4, 4, 2, 2, 1]
    assert out["head"] == [True] + [False] * 7


def test_results_prune_the_postings_once(spark, monkeypatch):
    kept, real = [], I.index_postings
    monkeypatch.setattr(I, "index_postings", lambda champs, *a: (kept.append(champs), real(champs, *a))[1])
    P.results(spark, SF001)
    (champs,) = kept  # a written table with df: N, df and norms work out no champion list again
    plan = champs._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Window" not in plan and "df" in champs.columns
    lazy, held = P.index(spark, SF001), P.index(spark, SF001, kept=True)
    cols = ["term", "rank", "doc_id", "tf", "df", "round(weight, 9)", "round(norm, 9)"]
    assert sorted(map(tuple, lazy.postings.selectExpr(*cols).collect())) == sorted(map(tuple, held.postings.selectExpr(*cols).collect()))


@pytest.mark.parametrize("q", [1, 2, 3, 5, 7, 16, 31])
def test_hashes_by_doubling_are_the_polynomial(q):
    codes = np.random.default_rng(q).integers(0, 0x110000, 90).astype(np.uint64)
    want = []
    for i in range(len(codes) - q + 1):
        h = 0
        for c in codes[i : i + q].tolist():
            h = (h * int(containment._BASE) + c) % 2**64
        h = (h ^ h >> 30) * int(containment._M1) % 2**64
        h = (h ^ h >> 27) * int(containment._M2) % 2**64
        want.append(h ^ h >> 31)
    assert containment._qgram_hashes(codes, q).tolist() == want
    assert containment._qgram_hashes(codes[: q - 1], q).size == 0


def test_counts_of_sorted_tokens(spark):
    rows = [(1, ["b", "a", "b", "é"], 4), (2, [], 0), (3, ["", "a", None, "a"], 4), (4, ["z"], 1)]
    got = I.term_counts(spark.createDataFrame(rows, "doc_id long, tokens array<string>, n_terms int"))
    assert {(r["doc_id"], r["term"]): r["cnt"] for r in got.collect() if r["doc_id"] != 3} == {(1, "a"): 1, (1, "b"): 2, (1, "é"): 1, (4, "z"): 1}
    assert {r["term"]: r["cnt"] for r in got.where("doc_id = 3").collect()} == {"": 1, "a": 2}
