"""Stop-word lists.

``ENGLISH`` is the English stop list the analysed corpora are filtered with.
The entries are fixed values: they must stay exactly as listed for results to
agree with the behaviour this engine reproduces.  Entries holding an apostrophe
can never survive cleaning; ``effective_stop_words`` therefore adds what such
entries become after cleaning (``should've`` -> ``should``, ``ve``), which
matters for user-supplied lists.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

# --- fixed values: English stop list (179 entries, natural order) -----------
ENGLISH: tuple[str, ...] = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your
    yours yourself yourselves he him his himself she she's her hers herself it
    it's its itself they them their theirs themselves what which who whom this
    that that'll these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after
    above below to from up down in out on off over under again further then
    once here there when where why how all any both each few more most other
    some such no nor not only own same so than too very s t can will just don
    don't should should've now d ll m o re ve y ain aren aren't couldn
    couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't
    isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
    shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)
# --- end of fixed values -----------------------------------------------------

def _clean_pieces(word: str) -> list[str]:
    pieces = re.split(r"\d+|[^\w]+", word)
    return [p for p in pieces if len(p) > 1]


def effective_stop_words(words: Iterable[str]) -> list[str]:
    """The list plus each entry as it looks after cleaning, lower-cased, deduplicated, sorted."""
    out: set[str] = set()
    for w in words:
        lw = w.lower()
        out.add(lw)
        out.update(p.lower() for p in _clean_pieces(w))
    return sorted(out)


def spark_default_stop_words(spark, language: str = "english") -> list[str]:
    """Spark ML's bundled stop list for ``language`` (needs a live session)."""
    from pyspark.ml.feature import StopWordsRemover

    spark.sparkContext  # make sure the JVM is up
    return list(StopWordsRemover.loadDefaultStopWords(language))


def resolve_stop_words(spark, stop_words) -> list[str]:
    """Accept ``None``/"english" (default list), "spark" (Spark ML list) or any iterable."""
    if stop_words is None or stop_words == "english":
        return effective_stop_words(ENGLISH)
    if stop_words == "spark":
        return effective_stop_words(spark_default_stop_words(spark))
    if isinstance(stop_words, str):
        raise ValueError(f"unknown stop list {stop_words!r}")
    return effective_stop_words(stop_words)
