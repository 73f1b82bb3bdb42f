"""Column expressions for text analysis.

Everything here returns a ``Column`` built from Spark's JVM functions (regex
split, higher-order array functions), so a whole analysis chain is one narrow
Project inside whole-stage code generation -- no Python UDF.

Character classes follow the Unicode semantics of Python's ``re`` module:
``\\w`` is letters, numbers and ``_``; ``\\d`` is decimal digits.  Cleaning
replaces digit runs and every character that is neither a word character nor
white space by a blank, drops stand-alone single characters and collapses white
space.  After cleaning, the text is exactly the runs of characters from
``TOKEN_CLASS`` of length two or more, joined by single blanks, which is how
it is computed here: one regex split instead of four substitutions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: character classes (Java regex syntax, also valid RE2) -----
WORD_CLASS = r"\p{L}\p{N}_"  # word characters
SPACE_CLASS = (
    r"\t\n\f\r\x{0B}\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)  # white space
TOKEN_CLASS = r"\p{L}\p{Nl}\p{No}_"  # word characters that are not decimal digits
SEPARATOR = r"[^\p{L}\p{Nl}\p{No}_]+"
ALPHA = r"^\p{L}+$"
# Forms the word tokenizer splits in two after cleaning; each splits after its
# third character (can|not, gim|me, gon|na, got|ta, lem|me, wan|na).
FUSED_FORMS: tuple[str, ...] = ("cannot", "gimme", "gonna", "gotta", "lemme", "wanna")
# --- end of fixed values ------------------------------------------------------


def _text(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(""))


def raw_tokens(text) -> Column:
    """Cleaned text as an array: word runs without digits, two or more characters long."""
    return F.filter(F.split(_text(text), SEPARATOR), lambda w: F.char_length(w) > 1)


def clean_text(text) -> Column:
    """The cleaned text string (digits, punctuation, single characters removed)."""
    return F.array_join(raw_tokens(text), " ")


def split_fused_lowered(lowered: Column) -> Column:
    """X2 refinement: split the fused forms the word tokenizer separates, in a lower-cased token
    array (pass a column, not an expression)."""
    fused = list(FUSED_FORMS)
    return F.when(
        F.exists(lowered, lambda w: w.isin(fused)),
        F.flatten(
            F.transform(
                lowered,
                lambda w: F.when(w.isin(fused), F.array(F.substring(w, 1, 3), F.substring(w, 4, 1 << 30))).otherwise(
                    F.array(w)
                ),
            )
        ),
    ).otherwise(lowered)


def keep_terms(tokens: Column, stop_words: Sequence[str]) -> Column:
    """F3 + F4 in one pass: longer than one character, not a stop word, letters only."""
    words = list(stop_words)
    return F.filter(
        tokens,
        lambda w: (F.char_length(w) > 1) & (~w.isin(words) if words else F.lit(True)) & w.rlike(ALPHA),
    )


def tokenize(cleaned) -> Column:
    """Tokens of an already cleaned string (blank separated), fused forms whole."""
    return F.filter(F.split(_text(cleaned), " "), lambda w: F.char_length(w) > 0)


def lower_tokens(tokens: Column) -> Column:
    """Lower-case every token (after tokenising)."""
    return F.transform(tokens, lambda w: F.lower(w))


def remove_stop_words(tokens: Column, stop_words: Sequence[str]) -> Column:
    """drop tokens found in ``stop_words``; order and duplicates are kept."""
    words = list(stop_words)
    if not words:
        return tokens
    return F.filter(tokens, lambda w: ~w.isin(words))


def alpha_filter(tokens: Column) -> Column:
    """keep tokens made only of letters and longer than one character."""
    return F.filter(tokens, lambda w: w.rlike(ALPHA) & (F.char_length(w) > 1))


def first_number(name) -> Column:
    """First run of decimal digits in a name, leading zeros kept; NULL when none."""
    col = F.col(name) if isinstance(name, str) else name
    return F.nullif(F.regexp_extract(col, r"(\p{Nd}+)", 1), F.lit(""))
