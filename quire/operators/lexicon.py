"""Lemmatisation as joins over the distinct vocabulary.

A per-token tagger and lemmatiser are replaced by vocabulary-level tables:
tags ``(form, tag)``, a lexicon ``(form, pos, lemma)``, and the resulting
lemma map ``(term, lemma)``.  The vocabulary is far smaller than the token
stream, and the lemma map is applied to term counts (a join on ``term`` and a
re-aggregation), never to individual tokens.  Tags are context-free: a form
gets one class whatever its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: WordNet morphological detachment rules (suffix -> ending) --
NOUN_RULES = (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
              ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"))
VERB_RULES = (("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"),
              ("ed", ""), ("ing", "e"), ("ing", ""))
ADJ_RULES = (("er", ""), ("est", ""), ("er", "e"), ("est", "e"))
# Tag classes: first letter of a Penn tag -> WordNet class; anything else is a noun.
TAG_CLASSES = (("J", "a"), ("V", "v"), ("N", "n"), ("R", "r"))
DEFAULT_CLASS = "n"
# --- end of fixed values ------------------------------------------------------


def rule_rows() -> list[tuple[str, str, str]]:
    return (
        [("n", s, e) for s, e in NOUN_RULES]
        + [("v", s, e) for s, e in VERB_RULES]
        + [("a", s, e) for s, e in ADJ_RULES]
    )


def tag_class(tag) -> Column:
    """Penn tag -> ``a``/``v``/``n``/``r``; unknown or missing tags -> ``n``."""
    t = F.col(tag) if isinstance(tag, str) else tag
    first = F.substring(F.coalesce(t, F.lit("")), 1, 1)
    expr = F.when(F.lit(False), F.lit(None))
    for letter, cls in TAG_CLASSES:
        expr = expr.when(first == letter, F.lit(cls))
    return expr.otherwise(F.lit(DEFAULT_CLASS))


def vocabulary(counts: DataFrame, term: str = "term") -> DataFrame:
    """Distinct terms ``(term)`` of a long term table."""
    return counts.select(term).distinct()


def learn_tags(tagged: DataFrame) -> DataFrame:
    """Most frequent tag per form from observations ``(form, tag)``, or ``(form, tag, n)`` counted; ties by tag."""
    n = F.sum("n") if "n" in tagged.columns else F.count(F.lit(1))
    counted = tagged.groupBy("form", "tag").agg(n.alias("n"))
    w = Window.partitionBy("form").orderBy(F.col("n").desc(), F.col("tag").asc())
    return counted.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("form", "tag")


def tag_vocabulary(vocab: DataFrame, tags: DataFrame | None = None) -> DataFrame:
    """``(form, pos)`` for every vocabulary term; untagged forms are nouns."""
    v = vocab.select(F.col(vocab.columns[0]).alias("form"))
    if tags is None:
        return v.select("form", F.lit(DEFAULT_CLASS).alias("pos"))
    return v.join(tags.select("form", "tag"), "form", "left").select("form", tag_class("tag").alias("pos"))


def build_lexicon(vocab: DataFrame) -> DataFrame:
    """L3: ``(form, pos, lemma)`` from the detachment rules, keeping lemmas that are themselves
    vocabulary terms; several candidates -> shortest, then alphabetical."""
    v = vocab.select(F.col(vocab.columns[0]).alias("form"))
    form = F.col("form")
    # One narrow pass: the candidates of a form are an array over the rules that fit it.
    fitting = F.array_compact(F.array(*[
        F.when(
            form.endswith(suffix) & (F.length(form) > len(suffix)),
            F.struct(F.lit(pos).alias("pos"), F.concat(F.left(form, F.length(form) - len(suffix)), F.lit(ending)).alias("lemma")),
        )
        for pos, suffix, ending in rule_rows()
    ]))
    cands = v.select("form", F.inline(fitting)).where(F.col("lemma") != form)
    known = cands.join(v.select(F.col("form").alias("lemma")), "lemma", "left_semi")
    w = Window.partitionBy("form", "pos").orderBy(F.length("lemma").asc(), F.col("lemma").asc())
    return known.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("form", "pos", "lemma")


def lemmatize_vocabulary(tagged_vocab: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``(term, lemma)``: the lexicon entry for (form, class), else the form itself."""
    w = Window.partitionBy("form", "pos").orderBy(F.length("lemma").asc(), F.col("lemma").asc())
    best = lexicon.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("form", "pos", "lemma")
    return tagged_vocab.join(best, ["form", "pos"], "left").select(
        F.col("form").alias("term"), F.coalesce("lemma", "form").alias("lemma")
    )


def apply_lemmas(counts: DataFrame, lemma_map: DataFrame, keys: list[str]) -> DataFrame:
    """Replace ``term`` by its lemma in a long count table and re-aggregate.

    ``counts`` holds ``keys + [term, cnt]`` and optionally ``pos`` (first
    position, kept as the minimum).  A map as ``lemma_map_for`` makes it holds
    changed forms only; kept as a table (``util.stored``), its measured size
    decides whether it is broadcast.
    """
    joined = counts.join(lemma_map, "term", "left").withColumn("term", F.coalesce("lemma", "term"))
    aggs = [F.sum("cnt").cast("int").alias("cnt")]
    if "pos" in counts.columns:
        aggs.append(F.min("pos").cast("int").alias("pos"))
    return joined.groupBy(*keys, "term").agg(*aggs)


def lemma_map_for(vocab: DataFrame, tags: DataFrame | None = None, lexicon: DataFrame | None = None) -> DataFrame:
    """L1 + L3 + L2 in one: ``(term, lemma)`` for the terms whose lemma is another word."""
    lex = lexicon if lexicon is not None else build_lexicon(vocab)
    return lemmatize_vocabulary(tag_vocabulary(vocab, tags), lex).where(F.col("lemma") != F.col("term"))
