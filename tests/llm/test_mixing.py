"""Raked mixing against its SQL mirror and the targets it rakes to."""

import duckdb
import pytest

from quire.llm import mixing as M

from ..conftest import SF001
from . import edge


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    res = con.execute(M.mix_sql())
    cols = [d[0] for d in res.description]
    got = M.mix(spark.read.parquet(f"{SF001}/documents.parquet")).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(res.fetchall())


def test_margins_reach_their_targets(spark):
    cells = [("s1", "en", "t1", 900), ("s1", "de", "t1", 50), ("s2", "en", "t1", 300), ("s2", "de", "t2", 200), ("s2", "en", "t2", 100), ("s1", "de", "t2", 80)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    out = [r.asDict() for r in M.rake(df, rate=0.2, rounds=25).collect()]
    total = sum(c[3] for c in cells)
    for k, margin in enumerate(M.MARGINS):
        natural = {}
        for c in cells:
            natural[c[k]] = natural.get(c[k], 0) + c[3]
        power = sum(v**M.TEMPERATURE for v in natural.values())
        for value, n in natural.items():
            raked = sum(r["raked"] for r in out if r[margin] == value)
            assert raked == pytest.approx(n**M.TEMPERATURE / power * total, rel=0.02)
    assert all(0 < r["probability"] <= 1 for r in out)
    kept = sum(r["probability"] * r["tokens"] for r in out)
    assert kept == pytest.approx(0.2 * total, rel=0.02)


def test_a_scarce_cell_is_capped_at_probability_one(spark):
    df = spark.createDataFrame([("s", "en", "t", 1000), ("s", "de", "t", 1)], "source string, lang string, topic string, tokens long")
    got = {r["lang"]: r["probability"] for r in M.rake(df, rate=0.5, temperature=0.1).collect()}
    assert got["de"] == 1.0 and got["en"] <= 1.0


def test_edge_rows(spark):
    df = edge.table(spark)
    out = M.mix(df).collect()
    assert len(out) == len(edge.ROWS)
    by_null = [r for r in out if r["doc_id"] == 2][0]
    assert (by_null["source"], by_null["lang"], by_null["tokens"], by_null["probability"]) == ("", "", 0, M.RATE)
    stage = M.mixed(df)
    assert stage.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in stage.collect()) == sorted(str(r["doc_id"]) for r in out if r["kept"])
    assert M.mix(edge.empty(spark)).count() == 0 and M.mixed(edge.empty(spark)).count() == 0
