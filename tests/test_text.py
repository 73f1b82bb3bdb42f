"""Hand cases for cleaning, tokenising, stop words and the alphabetic filter."""

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions.stopwords import ENGLISH
from quire.operators.analysis import AnalyzerConfig, analyze


def _one(spark, col, value):
    df = spark.createDataFrame([(value,)], "text string")
    return df.select(col.alias("v")).first()["v"]


def _analysed(spark, text):
    return analyze(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id").first()["tokens"]


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("don't stop", "don stop"),
        ("x1y2 abc123", "abc"),
        ("a_b", "a_b"),
        ("é té", "té"),
        ("x²y", "x²y"),
        ("  Hello,   World!! ", "Hello World"),
        ("٣٤abc", "abc"),
        ("a bb cc", "bb cc"),
        ("", ""),
    ],
)
def test_clean(spark, raw, cleaned):
    assert _one(spark, T.clean_text(F.col("text")), raw) == cleaned


def test_clean_null_is_empty(spark):
    assert _one(spark, T.clean_text(F.col("text")), None) == ""


def test_fused_forms_split(spark):
    df = spark.createDataFrame([("Cannot gonna wanna canned",)], "text string")
    low = df.select(T.lower_tokens(T.tokenize(T.clean_text(F.col("text")))).alias("t"))
    assert low.select(T.split_fused_lowered(F.col("t"))).first()[0] == ["can", "not", "gon", "na", "wan", "na", "canned"]


def test_analysis_chain(spark):
    got = _analysed(spark, "Don't STOP the x²y a_b Null nan Zoë")
    # don/the are stop words, x²y and a_b fail the alphabetic filter, null stays a term
    assert got == ["stop", "null", "nan", "zoë"]


def test_stop_list_keeps_duplicates_and_order(spark):
    got = _analysed(spark, "beta alpha the beta")
    assert got == ["beta", "alpha", "beta"]


def test_stop_list_fixed_values():
    assert len(ENGLISH) == 179 and len(set(ENGLISH)) == 179
    assert {"don", "ll", "ve", "isn", "mightn", "needn"} <= set(ENGLISH)


def test_empty_documents_dropped(spark):
    df = spark.createDataFrame([(1, "the and of"), (2, ""), (3, "real words here")], "doc_id long, text string")
    out = analyze(df, "doc_id").orderBy("doc_id").collect()
    assert [(r["doc_id"], r["tokens"], r["n_terms"]) for r in out] == [(3, ["real", "words"], 2)]


def test_dictionary_is_a_table_and_shortens_documents(spark):
    from quire.operators.index import build_index

    df = spark.createDataFrame([(1, "apple zzkq banana"), (2, "zzkq")], "doc_id long, text string")
    words = spark.createDataFrame([("apple",), ("banana",), ("banana",)], "word string")
    got = build_index(analyze(df, "doc_id"), dictionary=words).postings.select("term", "doc_id", "tf").collect()
    assert sorted(map(tuple, got)) == [("apple", 1, 0.5), ("banana", 1, 0.5)]


def test_first_number(spark):
    df = spark.createDataFrame([("output_007.txt",), ("readme.txt",), ("a12b34",)], "n string")
    got = [r[0] for r in df.select(T.first_number("n")).collect()]
    assert got == ["007", None, "12"]


def test_dataframe_analysis_matches_model_on_fused_and_unicode(spark):
    from tests import pymodel

    texts = [
        "Cannot GONNA wanna go; gotta lemme gimme x1y2 a_b",
        "İstanbul Straße ÉCOLE naïve café x²y 123abc",
        "don't stop the music, they're here!",
        "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["tokens"] for r in analyze(df, "doc_id", keep_empty=True).collect()}
    assert got == {i: pymodel.analyse(t) for i, t in enumerate(texts)}


def test_stop_list_options(spark):
    from quire.functions.stopwords import resolve_stop_words

    spark_list = resolve_stop_words(spark, "spark")
    assert "the" in spark_list and "ll" in spark_list  # "i'll" contributes its cleaned stem
    custom = resolve_stop_words(spark, ["Can't", "FOO"])
    assert custom == ["can", "can't", "foo"]
    df = spark.createDataFrame([(1, "can't foo bar")], "doc_id long, text string")
    out = analyze(df, "doc_id", cfg=AnalyzerConfig(stop_words=["Can't", "FOO"])).first()
    assert out["tokens"] == ["bar"]
