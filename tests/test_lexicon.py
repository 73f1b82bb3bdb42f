"""Vocabulary-level tagging and lemmatisation."""

from pyspark.sql import functions as F

from quire.operators import index as I
from quire.operators import lexicon as L
from quire.operators import retrieve as R
from quire.operators.analysis import analyze


def test_tag_class(spark):
    df = spark.createDataFrame([("JJ",), ("VBD",), ("NNS",), ("RB",), ("DT",), (None,)], "tag string")
    assert [r[0] for r in df.select(L.tag_class("tag")).collect()] == ["a", "v", "n", "r", "n", "n"]


def test_learn_tags_majority_then_alphabetical(spark):
    obs = spark.createDataFrame(
        [("run", "VB"), ("run", "NN"), ("run", "VB"), ("fast", "RB"), ("fast", "JJ")], "form string, tag string"
    )
    assert sorted(map(tuple, L.learn_tags(obs).collect())) == [("fast", "JJ"), ("run", "VB")]


def test_rule_lexicon_and_lemma_map(spark):
    vocab = spark.createDataFrame([(w,) for w in "dogs dog cities city played play boxes box wolves".split()], "term string")
    lex = {(r["form"], r["pos"]): r["lemma"] for r in L.build_lexicon(vocab).collect()}
    assert lex[("dogs", "n")] == "dog" and lex[("cities", "n")] == "city" and lex[("boxes", "n")] == "box"
    assert lex[("played", "v")] == "play"
    assert ("wolves", "n") not in lex  # "wolf" is not a vocabulary term
    tags = spark.createDataFrame([("played", "VBD")], "form string, tag string")
    m = dict(map(tuple, L.lemma_map_for(vocab, tags).collect()))
    assert m == {"played": "play", "dogs": "dog", "cities": "city", "boxes": "box"}  # changed forms only


def test_lemmatised_index_and_query(spark):
    docs = spark.createDataFrame([(1, "dogs dog cats"), (2, "cat mouse"), (3, "mouse mice")], "doc_id long, text string")
    p = analyze(docs, "doc_id")
    vocab = I.term_counts_grouped(p).select("term").distinct()
    lm = L.lemma_map_for(vocab)
    idx = I.build_index(p, lemma_map=lm)
    terms = {r["term"]: r["df"] for r in idx.terms.collect()}
    assert "dogs" not in terms and terms["dog"] == 1 and terms["cat"] == 2
    tf = {r["term"]: r["tf"] for r in idx.postings.where("doc_id = 1").collect()}
    assert tf["dog"] == round(2 / 3, 6)
    q = spark.createDataFrame([(9, "cats")], "query_id long, query_text string")
    res = R.search(idx, q, lemma_map=lm).orderBy("rank").collect()
    # idf(cat) = ln(3/3) = 0: all scores are 0, and ties keep the posting order (tf 0.5 before 0.333333).
    assert [(r["doc_id"], r["score"]) for r in res] == [(2, 0.0), (1, 0.0)]
    q = spark.createDataFrame([(9, "dog mice")], "query_id long, query_text string")
    res = R.search(idx, q, lemma_map=lm).orderBy("rank").collect()
    assert [r["doc_id"] for r in res] == [1, 3]


def test_rules_need_no_join_with_the_vocabulary(spark):
    plan = L.build_lexicon(spark.createDataFrame([("dogs",)], "term string"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
