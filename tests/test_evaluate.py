"""AP@k / recall@k / MAP / MAR hand cases."""

import math

from quire.operators import evaluate as E

from . import pymodel


def _ranked(spark, rows):
    df = spark.createDataFrame(rows, "query_id string, rank int, doc_name string")
    return E.ranked_ids(df)


def _qrels(spark, rows):
    return E.normalize_qrels(spark.createDataFrame(rows, "query_id string, doc_no string"))


def test_average_precision_hand_case(spark):
    ranked = _ranked(spark, [("q", 1, "d1"), ("q", 2, "d9"), ("q", 3, "d2"), ("q", 4, "d1")])
    qrels = _qrels(spark, [("q", "1"), ("q", "2"), ("q", "3")])
    ap = {r["k"]: r["ap"] for r in E.ap_at_k(ranked, qrels, [3]).collect()}
    assert math.isclose(ap[3], (1 / 1 + 2 / 3) / 3)
    assert math.isclose(ap[3], pymodel.average_precision(["1", "2", "3"], ["1", "9", "2", "1"], 3))


def test_repeated_retrieved_id(spark):
    ranked = _ranked(spark, [("q", 1, "x1"), ("q", 2, "x1")])
    qrels = _qrels(spark, [("q", "1")])
    assert E.ap_at_k(ranked, qrels, [2]).first()["ap"] == 2.0
    assert E.recall_at_k(ranked, qrels, [2]).first()["recall"] == 1.0


def test_judgements_are_sets_whatever_is_passed(spark):
    ranked = _ranked(spark, [("q", 1, "x1"), ("q", 2, "x5"), ("q", 3, "x2")])
    raw = spark.createDataFrame([("q", 1), ("q", 1), ("q", 2), ("q", None), (None, 3)], "query_id string, doc_no int")
    m = E.map_mar(ranked, raw, [3]).first()
    assert math.isclose(m["map_k"], (1 + 2 / 3) / 2) and m["mar_k"] == 1.0


def test_judged_query_without_results_and_unjudged_query(spark):
    ranked = _ranked(spark, [("other", 1, "d4")])
    qrels = _qrels(spark, [("q", "4")])
    m = E.map_mar(ranked, qrels, [3, 10]).orderBy("k").collect()
    assert [(r["k"], r["map_k"], r["mar_k"]) for r in m] == [(3, 0.0, 0.0), (10, 0.0, 0.0)]


def test_names_without_digits_dropped_and_ranks_close_up(spark):
    ranked = _ranked(spark, [("q", 1, "readme.txt"), ("q", 2, "output_007.txt"), ("q", 3, "output_7.txt")])
    rows = [(r["rank"], r["doc_no"]) for r in ranked.orderBy("rank").collect()]
    assert rows == [(1, "007"), (2, "7")]
    qrels = _qrels(spark, [("q", "7")])
    ap = E.ap_at_k(ranked, qrels, [1, 2]).orderBy("k").collect()
    assert [r["ap"] for r in ap] == [0.0, 0.5]  # 007 is not 7


def test_no_queries_at_all(spark):
    ranked = _ranked(spark, [("q", 1, "d1")])
    qrels = _qrels(spark, [(None, "1")])
    m = E.map_mar(ranked, qrels, [3]).collect()
    assert (m[0]["map_k"], m[0]["mar_k"]) == (0.0, 0.0)
