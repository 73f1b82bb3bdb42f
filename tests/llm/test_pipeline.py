"""The pipeline: what each stage drops and keeps, against plain rules; awkward rows; registration."""

import __spark_entry__ as entry
import corpus_pipeline as C
from quire.llm import langid, mixing
from quire.llm.common import stored

from ..conftest import SF001
from . import edge
from .test_ngram_join import brute


def stages(spark, docs, sf_dir):
    out = [docs]
    for name, stage in C.STAGES:
        out.append(stored(stage(spark, out[-1], sf_dir), f"test-{name}"))
    return out


def test_stages_against_plain_rules(spark):
    docs, lang, exact, near, mix, pack = stages(spark, spark.read.parquet(f"{SF001}/documents.parquet"), SF001)
    for df in (lang, exact, near, mix):
        assert df.columns == docs.columns
    rows = [{r["doc_id"]: r["text"] for r in df.collect()} for df in (docs, lang, exact, near, mix)]
    assert all(set(b.items()) <= set(a.items()) for a, b in zip(rows, rows[1:], strict=False))
    told = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert set(rows[1]) == {d for d, r in told.items() if r["lang_pred"] != "und" and r["score"] >= langid.MIN_SCORE}
    largest = {}
    for d, t in rows[1].items():
        largest[t] = max(largest.get(t, -1), d)
    assert set(rows[2]) == set(largest.values())
    assert set(rows[3]) == {c for d, _, c in brute(list(rows[2].items())) if d == c}
    assert set(rows[4]) == {r["doc_id"] for r in mixing.mix(near).collect() if r["kept"]}
    pieces = pack.collect()
    assert {r["doc_id"] for r in pieces} == set(rows[4])
    for d in rows[4]:
        mine = [r for r in pieces if r["doc_id"] == d]
        assert sum(r["length"] for r in mine) == mine[0]["doc_tokens"]


def test_awkward_rows_and_empty_tables(spark):
    for docs in (edge.table(spark), edge.empty(spark)):
        out = stages(spark, docs, SF001)
        assert all(df.columns == docs.columns for df in out[:-1])
        assert {r["doc_id"] for r in out[-1].collect()} == {r["doc_id"] for r in out[-2].collect()}


def test_registered():
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert names["pipeline"] is C.run and 4 <= len(C.STAGES) <= 5
