"""License scan: families, unknown texts, and rows of every kind."""

import pytest

from quire.llm import licenses as X

from ..conftest import SF001
from . import edge


@pytest.fixture(scope="module")
def classifier(spark):
    return X.train(spark.read.parquet(f"{SF001}/documents.parquet"))


def test_training_separates_the_classes(classifier):
    assert classifier.accuracy > 0.97


@pytest.mark.parametrize("family", X.TEMPLATES)
def test_every_template_is_found_as_it_is_and_amid_other_words(classifier, family):
    for text in X.TEMPLATES[family]:
        assert classifier.classify(X.words_of(text))[0] == family, text
        around = "some other words here " + text.upper() + " and then more of them"
        assert classifier.classify(X.words_of(around))[0] == family, text


def test_long_paragraphs_are_read_in_windows(classifier):
    words = X.words_of("filler words of no meaning " * 60 + X.TEMPLATES["mpl-2.0"][1] + " filler words of no meaning" * 60)
    assert classifier.classify(words)[0] == "mpl-2.0"
    assert [len(w) for w in X.windows(list("a" * 150))][:1] == [60] and sum(X.windows(list(range(150))), [])[-1] == 149


@pytest.mark.parametrize("text", X.NEAR_MISSES + ("", "plain words", "license", "the software was released", "a permission slip for the library"))
def test_near_misses_stay_unknown(classifier, text):
    assert classifier.classify(X.words_of(text))[0] == X.UNKNOWN


def test_frequent_words_do_not_hide_a_statement():
    prose = [f"The {w} was licensed under terms of the city and released for the public {w} version" for w in ("bar", "taxi", "film", "school", "bank", "port", "club", "shop", "farm", "mine")]
    c = X.Classifier([f"{p} {k}" for k in range(8) for p in prose])
    for family in ("cc-by", "cc-by-sa", "mit", "gpl-3.0"):
        assert c.classify(X.words_of(X.TEMPLATES[family][0]))[0] == family
    assert {c.classify(X.words_of(p))[0] for p in prose} == {X.UNKNOWN}


def test_every_licence_of_a_line_is_found(spark, classifier):
    filler = " filler words of no meaning" * 30 + " "
    mit, apache, gpl = X.TEMPLATES["mit"][0], X.TEMPLATES["apache-2.0"][0], X.TEMPLATES["gpl-3.0"][0]
    rows = [f"{mit} {apache}", mit + filler + gpl, " ".join(X.TEMPLATES["mit"]) + filler + mit, apache + "\n" + gpl + " All rights reserved."]
    got = X.find(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), classifier).orderBy("doc_id").collect()
    assert [[(f["paragraph"], f["family"]) for f in r["found"]] for r in got] == [
        [(0, "mit"), (0, "apache-2.0")], [(0, "mit"), (0, "gpl-3.0")], [(0, "mit"), (0, "mit")], [(0, "apache-2.0"), (1, "gpl-3.0"), (1, "proprietary")]]


@pytest.mark.parametrize("text", ["of the", "to the", "in the software", "under the terms of the agreement", "any person", "the terms of the", "without restriction of any kind", "the above conditions", "either version of the work"])
def test_common_words_alone_are_no_licence(classifier, text):
    assert classifier.classify(X.words_of(text))[0] == X.UNKNOWN


def test_supplied_rows(spark, classifier):
    truth = {
        "Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "All rights reserved.": "proprietary",
    }
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    for r in X.find(df, classifier).collect():
        want = [(k, truth[x]) for k, x in enumerate(texts[r["doc_id"]].split("\n")) if x in truth]
        assert [(f["paragraph"], f["family"]) for f in r["found"]] == want


def test_edge_rows(spark):
    df = edge.table(spark)
    out = X.licenses(df).collect()
    assert len(out) == len(edge.ROWS) and {r["license"] for r in out} == {X.UNKNOWN}
    assert X.licenses(edge.empty(spark)).count() == 0
