"""Exact dedup against grouping by text."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quire.llm import exact_dedup as X

from . import edge


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    out = []
    for text, docs in groups.items():
        keep = max((d for d in docs if d is not None), default=None)
        sha, left = hashlib.sha256(text.encode()).hexdigest(), 1
        for d in docs:
            kept = left if d == keep else 0
            left -= kept
            out.append((d, keep, len(docs), bool(kept), sha))
    return sorted(out, key=str)


def check(df, **options):
    got = X.exact_duplicates(df, **options).collect()
    assert sorted(map(tuple, got), key=str) == brute([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])


def test_edge_rows(spark):
    check(edge.table(spark))


def test_empty_table(spark):
    out = X.exact_duplicates(edge.empty(spark))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and out.count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_and_levels(spark, seed):
    """Texts of many small blocks that differ late, in length, or not at all."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab") for _ in range(rng.choice([3, 4, 8, 15, 33]))) for _ in range(12)]
    rows = [(k, rng.choice(base) + rng.choice(["", "", "a", "ab"])) for k in range(120)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), block_bytes=4)


def test_shared_addresses_are_settled_by_content(spark):
    rows = [(k, "text %d" % (k % 7)) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df, block_bytes=4, address=lambda b: F.pmod(F.xxhash64(b), F.lit(2)))


def test_stage_keeps_one_row_and_all_columns(spark):
    df = edge.table(spark)
    out = X.keep_one(df)
    assert out.columns == df.columns
    rows = out.collect()
    texts = [r["text"] or "" for r in rows]
    assert len(texts) == len(set(texts)) == len({r["text"] or "" for r in df.collect()})
    fox = [r for r in rows if r["text"] and r["text"].startswith("The quick")]
    assert [r["doc_id"] for r in fox] == [5]
    assert X.keep_one(edge.empty(spark)).count() == 0


def test_native(spark):
    plan = X.exact_duplicates(edge.table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
