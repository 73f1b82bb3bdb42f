"""tf is stored exactly as six-decimal printing of the double ratio would give."""

import random

from pyspark.sql import functions as F

from quire.functions.scoring import rounded_ratio


def test_rounded_ratio_matches_fixed_point_printing(spark):
    pairs = [(1, 128), (1, 640), (3, 640), (1, 3200), (7, 16000), (5, 128), (1, 3), (2, 3), (1, 1), (13, 80000)]
    rng = random.Random(7)
    for _ in range(20000):
        n = rng.randint(1, 40000)
        pairs.append((rng.randint(1, n), n))
    for n in (128, 640, 3200, 16000):
        pairs += [(c, n) for c in range(1, n, 7)]
    df = spark.createDataFrame(pairs, "cnt int, n int")
    got = df.select("cnt", "n", rounded_ratio("cnt", "n").alias("tf")).collect()
    bad = [(r["cnt"], r["n"], r["tf"]) for r in got if r["tf"] != float(f"{r['cnt'] / r['n']:.6f}")]
    assert bad == []
