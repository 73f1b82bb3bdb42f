"""Secret scan: fixed patterns, and sliding-window entropy over candidate strings.

All of it is column expressions on one row; nothing is shuffled.

*Patterns* (``assign``, ``access``, ``hex``) give the base spans.  A regular
expression is applied twice, as a splitter and as an extractor: pieces and hits
alternate, so the running sums of their lengths are the offsets.

*Entropy*: candidates are runs of ``MIN_RUN`` or more characters of the usual
token alphabet.  A window of ``WINDOW`` characters slides over each candidate.
Its character counts and its counts per class (digits, lower case, upper case,
outside hexadecimal) change by one entering and one leaving character, and so
does the sum of c*log2(c), so each step costs the same.  A window is hot when
its Shannon entropy reaches the threshold of its class; the hot windows of a
candidate make one span.  Candidates without a digit are spans of their own
kind (``letters``): there a window is hot when, besides, few of its letter
pairs are those of written words.  Candidates on the allow-list and spans within a base
span add nothing.

Offsets count code points; ends are exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_CHARS = 12
# A run is taken whole, so the least length can stand in the pattern itself.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy", "letters")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
MIN_RUN = WINDOW
BLOCK = 128  # items of one block of a running sum
CANDIDATE = "[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN
# Bits a window needs: hexadecimal characters only, both cases and digits, one case and digits, letters only.
# Each is what all but about one in a hundred windows of random characters of the class reach (the least class:
# lower-case hexadecimal, base62, base32, one case); a digit has to be among them, or the letters are judged as such.
HEX_BITS, MIXED_BITS, PLAIN_BITS, LETTER_BITS = 2.85, 3.6, 3.35, 3.2
HEX_DIGITS, MIXED_DIGITS, PLAIN_DIGITS = 1, 1, 1
# Letter pairs that most pairs of written words are among, and few of random letters; a window of letters may have so many.
PAIRS = (
    "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur "
    "ca el ta la ns di fo ho pe ec pr no ct us ac ot il tr ly nc et ut ss so rs un lo wa ge ie wh ee wi em ad ol rt po we na ul ni ts mo ow pa im mi ai sh "
    "ir su id os iv ia am fi ci vi pl ig tu ev ld ry mp fe bl ab gh ty op wo sa ay ex ke ui sc ei da do au qu ue ag ap bo ba ck ga gr ht lu mu nu od ov pi "
    "rd rm ru rn sp sy tt uc ud um up va vo ze zu"
).split()
LETTER_PAIRS = 9
# Strings that look random but are no secrets: UUIDs, plain numbers, one short unit repeated, placeholders, short words and
# numbers joined by marks (written without a repeated group, which Java would recurse into on a long one).
ALLOW = (
    "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    "^[0-9+/_=-]+$",
    "^(.{1,8}?)\\1+$",
    "(?i)example|placeholder|x{6,}|changeme",
    "^(?!.*\\+)(?!.*[A-Za-z]{16})(?!.*[0-9]{9})(?!.*[0-9][A-Za-z])(?!.*[A-Za-z][0-9]+[^0-9])(?!.*[A-Za-z][0-9]{5}).*$",
    # Words written together, with up to two numbers: no three pairs of letters in a row that words seldom have.
    "(?i)^(?=.*[a-z]{5})(?!.*\\+)(?!.*[0-9]{9})(?!(?:.*?[0-9](?![0-9])){3})(?!.*(?:(?!%s)[a-z](?=[a-z])){3}).*$" % "|".join(PAIRS),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, also where the body uses it in lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(items: Column, value, join) -> Column:
    """Running results of ``join`` over ``value(item)``, one per item; 0 has to be neutral.

    An array grows by copying, so results are gathered in blocks of ``BLOCK`` items, each continued
    from the blocks before: the work grows with the number of items, not with its square.
    """

    def grown(out, x):
        return F.concat(out, F.array(join(F.element_at(out, -1), x)))

    def joined(a):
        numbers = F.sequence(F.lit(0), F.floor((F.greatest(F.size(a), F.lit(1)) - 1) / BLOCK).cast("int"))
        blocks = F.transform(numbers, lambda b: F.aggregate(F.slice(a, b * BLOCK + 1, F.lit(BLOCK)), F.array(F.lit(0)), lambda out, x: grown(out, value(x))))
        return _let(blocks, continued)

    def continued(blocks):
        before = F.aggregate(blocks, F.array(F.lit(0)), lambda out, block: grown(out, F.element_at(block, -1)))
        each = F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), lambda block, at: F.transform(F.slice(block, F.lit(2), F.lit(BLOCK)), lambda v: join(at, v)))
        return F.flatten(each)

    return _let(items, joined)


def _hits(text: str, pattern: str, group: int | None = None) -> Column:
    """``array<struct<start, end, hit, value>>`` of the matches of ``pattern``, leftmost and non-overlapping."""
    col = F.col(text)
    hits = F.regexp_extract_all(col, F.lit(pattern), F.lit(0))
    value = hits if group is None else F.regexp_extract_all(col, F.lit(pattern), F.lit(group))
    steps = F.arrays_zip(F.slice(F.split(col, pattern, -1), 1, F.size(hits)).alias("before"), hits.alias("hit"), value.alias("value"))

    def placed(steps):
        ends = _running(steps, lambda x: F.char_length(x["before"]) + F.char_length(x["hit"]), lambda a, b: a + b)
        return F.zip_with(steps, ends, lambda x, end: F.struct((end - F.char_length(x["hit"])).alias("start"), end.alias("end"), x["hit"].alias("hit"), x["value"].alias("value")))

    return F.when(col.rlike(pattern), _let(steps, placed)).otherwise(F.expr("CAST(array() AS array<struct<start:int,end:int,hit:string,value:string>>)"))


def _spans(hits: Column, kind: str) -> Column:
    order = KINDS.index(kind)
    return F.transform(hits, lambda h: F.struct(h["start"].alias("start"), F.lit(order).alias("kind"), h["end"].alias("end")))


def _c_log_c(c: Column) -> Column:
    table = F.array(*[F.lit(k * math.log2(k) if k else 0.0) for k in range(WINDOW + 2)])
    return F.get(table, c)


def _common_pairs(string: Column) -> Column:
    """Per character 1 where it makes a pair of ``PAIRS`` with the one before it, else 0."""
    chars = F.split(F.lower(string), "")
    before = F.slice(F.concat(F.array(F.lit("")), chars), 1, F.size(chars))
    return F.zip_with(before, chars, lambda a, b: F.concat(a, b).isin(PAIRS).cast("int"))


def _hot_range(string: Column, letters: bool = False) -> Column:
    """``struct<first, last>``: start of the first and end of the last hot window of ``string``; first is null for none.

    ``letters``: the string has no digits, and its pairs are looked at too.
    """
    codes = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    moves = [codes.alias("new"), F.slice(F.concat(F.array_repeat(F.lit(-1), WINDOW), codes), 1, F.size(codes)).alias("old")]
    names = ["i", "counts", "sum", "digits", "lower", "upper", "other"]
    if letters:
        pairs = _common_pairs(string)
        moves += [pairs.alias("pair"), F.slice(F.concat(F.array_repeat(F.lit(0), WINDOW - 1), pairs), 1, F.size(pairs)).alias("old_pair")]
        names.append("pairs")
    steps = F.arrays_zip(*moves)
    zero = F.lit(0)
    start = F.struct(
        zero.alias("i"), F.array_repeat(zero, len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"),
        *[zero.alias(n) for n in names[3:]],
        F.lit(None).cast("int").alias("first"), zero.alias("last"),
    )

    def one(code, low, high):
        return F.when((code >= low) & (code < high), 1).otherwise(0)

    def not_hex(code):
        small, digit, large = (code >= 26) & (code < 32), (code >= 52) & (code < 62), (code >= 0) & (code < 6)
        return F.when((code < 0) | small | digit | large, 0).otherwise(1)

    def count(s, x):
        """Counts after the step: one character in, one out."""
        new, old = x["new"], x["old"]
        entered = F.get(s["counts"], new)
        left = F.when(old >= 0, F.get(s["counts"], old) + F.when(old == new, 1).otherwise(0)).otherwise(0)
        change = _c_log_c(entered + 1) - _c_log_c(entered) + F.when(left > 0, _c_log_c(left - 1) - _c_log_c(left)).otherwise(0.0)
        out = {"i": s["i"] + 1}
        out["counts"] = F.transform(s["counts"], lambda c, k: c + F.when(k == new, 1).otherwise(0) - F.when(k == old, 1).otherwise(0))
        out["sum"] = s["sum"] + change
        for name, low, high in (("upper", 0, 26), ("lower", 26, 52), ("digits", 52, 62)):
            out[name] = s[name] + one(new, low, high) - one(old, low, high)
        out["other"] = s["other"] + not_hex(new) - not_hex(old)
        if letters:
            out["pairs"] = s["pairs"] + x["pair"] - x["old_pair"]
        return out

    def step(s, x):
        c = count(s, x)
        bits = F.lit(math.log2(WINDOW)) - c["sum"] / WINDOW
        d = c["digits"]
        if letters:
            hot = (bits >= LETTER_BITS) & (c["pairs"] <= LETTER_PAIRS)
        else:
            hot = (
                ((c["other"] == 0) & (d >= HEX_DIGITS) & (c["lower"] + c["upper"] > 0) & (bits >= HEX_BITS))
                | ((c["lower"] > 0) & (c["upper"] > 0) & (d >= MIXED_DIGITS) & (bits >= MIXED_BITS))
                | ((c["lower"] + c["upper"] > 0) & (d >= PLAIN_DIGITS) & (bits >= PLAIN_BITS))
            )
        hot = hot & (c["i"] >= WINDOW)
        first = F.when(hot & s["first"].isNull(), c["i"] - WINDOW).otherwise(s["first"])
        last = F.when(hot, c["i"]).otherwise(s["last"])
        return F.struct(*[c[n].alias(n) for n in names], first.alias("first"), last.alias("last"))

    return F.aggregate(steps, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _entropy_spans(candidates: Column, kind: str) -> Column:
    """Spans of the candidates with a digit, or for ``letters`` of those without."""
    letters = kind == "letters"

    def judged(h):
        out = h["hit"].rlike("[0-9]") != F.lit(letters)
        for pattern in ALLOW:
            out = out & ~h["hit"].rlike(pattern)
        return out

    ranges = F.transform(F.filter(candidates, judged), lambda h: F.struct(h["start"].alias("start"), _hot_range(h["hit"], letters).alias("hot")))
    return F.transform(
        F.filter(ranges, lambda r: r["hot"]["first"].isNotNull()),
        lambda r: F.struct((r["start"] + r["hot"]["first"]).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (r["start"] + r["hot"]["last"]).alias("end")),
    )


def _outside_base(spans: Column) -> Column:
    """``spans`` (in order) without those of the entropy kinds that lie within a base span.

    In order of start and kind, a span lies within a base span where the largest end of the base spans so far reaches its own.
    """
    found = KINDS.index("entropy")

    def kept(spans):
        reach = _running(spans, lambda s: F.when(s["kind"] < found, s["end"]).otherwise(0), F.greatest)
        told = F.zip_with(spans, reach, lambda s, r: F.struct(s.alias("span"), ((s["kind"] < found) | (s["end"] > r)).alias("keep")))
        return F.transform(F.filter(told, lambda t: t["keep"]), lambda t: t["span"])

    return _let(spans, kept)


def _told(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    each = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` columns ``doc_id`` and ``text`` plus ``base`` and ``spans``: arrays of ``struct<start, kind, end>``.

    ``kind`` is the number in ``KINDS``; both are in order of start and kind.  A null text counts as
    empty and gives none.  Texts of any length are read whole, in time that grows with their length.
    """
    d = docs.select("doc_id", text_or_empty().alias("text"))
    assigned = F.filter(_hits("text", ASSIGN, 2), lambda h: F.char_length(h["value"]) >= ASSIGN_CHARS)
    base = F.sort_array(F.concat(_spans(assigned, "assign"), _spans(_hits("text", ACCESS), "access"), _spans(_hits("text", HEX), "hex")))
    d = d.withColumn("base", base).withColumn("candidates", _hits("text", CANDIDATE))
    found = [_entropy_spans(F.col("candidates"), kind) for kind in ("entropy", "letters")]
    return d.select("doc_id", "text", "base", _outside_base(F.sort_array(F.concat("base", *found))).alias("spans"))


def secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy, letters, n_letters)``, one row per row of ``docs``.

    ``spans`` are those of all kinds; ``letters`` tells those of candidates without a digit, which are
    less sure, once more.  Repeated rows are scanned each; columns other than doc_id and text are not
    read; an empty table gives an empty result.
    """
    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))

    def n(kind):
        return F.size(of(kind)).cast("bigint")

    return scan(docs).select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(_told(F.col("base")), 256).alias("base_sha256"), _told(F.col("spans")).alias("spans"), n("entropy").alias("n_entropy"),
        _told(of("letters")).alias("letters"), n("letters").alias("n_letters"),
    )
